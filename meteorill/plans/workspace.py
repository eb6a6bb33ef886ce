"""Where queries that write a table put it."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared one the cluster names in `spark.checkpoint.dir`.

    Only a local session may go without that setting; it uses the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="meteorill-")
    return f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"
