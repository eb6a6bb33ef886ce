"""Tables that are replaced as a whole: a reader sees one version or the next, never half of one.

A version is a folder of Parquet files under `data`, and a manifest under `versions` that names it. Files
are written first, by any number of tasks and attempts; then one rename puts the manifest in its place,
and that is the moment of publishing. A job that dies before leaves a folder that no manifest names. A reader takes the
manifest with the highest number once, and reads that version's files to the end. Two writers that
started from the same version cannot both publish: the second rename finds the name taken.

The newest `keep` versions stay, so that readers of the one before are not cut off; older ones, and the
folders of failed attempts before them, are deleted after a publish. The rename is atomic on HDFS and on local file systems;
an object store needs a committer that makes it so.
"""

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

#: Digits of a version's number in file names.
DIGITS = 12
KEEP = 2


class PublishConflict(RuntimeError):
    """Another writer has published since this one started."""


class Folder:
    """A folder of the shared file system, whichever that is, through Hadoop's interface."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.path.getFileSystem(self.conf)

    def child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def names(self, name: str) -> list[str]:
        """What lies in a folder inside, hidden files left out; none if it is not there."""
        at = self.child(name)
        if not self.fs.exists(at):
            return []
        return sorted(n for n in (s.getPath().getName() for s in self.fs.listStatus(at)) if not n.startswith((".", "_")))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.child(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """The whole file under its name, or PublishConflict if there is one already."""
        hidden = self.child(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = self.fs.create(hidden, False)
        stream.write(text.encode())
        stream.close()
        self._rename(hidden, self.child(name))

    def _rename(self, source, target) -> None:
        options = self.jvm.org.apache.hadoop.fs.Options
        array = self.jvm.java.lang.reflect.Array.newInstance(options.Rename.NONE.getClass(), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.makeQualified(target).toUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(source), self.fs.makeQualified(target), array)
        except Py4JJavaError as error:
            self.fs.delete(source, False)
            if "FileAlreadyExists" in str(error.java_exception.toString()):
                raise PublishConflict(f"{target.toString()} is there already") from error
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.child(name), True)


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Folder of each version that is still there, by number."""
    folder = Folder(spark, path)
    return {int(n): folder.read(f"versions/{n}") for n in folder.names("versions")}


def publish(
    df: DataFrame, path: str, write: Callable[[DataFrameWriter], DataFrameWriter] = lambda writer: writer, keep: int = KEEP
) -> int:
    """Write `df` as the next version and switch to it; gives its number.

    `write` sets options of the writer. `df` may read the current version.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    number = max(versions(spark, path), default=0) + 1
    name = f"{number:0{DIGITS}d}-{uuid.uuid4().hex}"
    write(df.write).parquet(f"{path}/data/{name}")
    folder.create(f"versions/{number:0{DIGITS}d}", name)
    expire(spark, path, keep)
    return number


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Delete all but the newest `keep` versions, manifests first, and the remains of attempts before them."""
    folder = Folder(spark, path)
    known = versions(spark, path)
    if len(known) < keep:
        return
    oldest = sorted(known)[-keep]
    for number in known:
        if number < oldest:
            folder.delete(f"versions/{number:0{DIGITS}d}")
    for name in folder.names("data"):
        if int(name.split("-")[0]) < oldest:
            folder.delete(f"data/{name}")


def read(spark: SparkSession, schema: StructType, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or that of a number; a table without versions is empty."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], schema)
    name = known[max(known) if version is None else version]
    return spark.read.schema(schema).parquet(f"{path}/data/{name}").select(schema.names)
