"""Versions of a table: whole ones for every reader, whatever happens to the writer."""

import pytest
from pyspark.sql import functions as F

from meteorill.schemas import WEATHER
from meteorill.sources import snapshots, tables


def weather(spark, value, n=30):
    rows = [(f"{c}{k}", 1 + k % 12, 2000, value, 2.0, 3.0, c, 1.0, 2.0, 3.0) for c in ("CH", "GM") for k in range(n)]
    return spark.createDataFrame(rows, WEATHER)


def values(df):
    return {(r.AvgTmax, r.n) for r in df.groupBy("AvgTmax").agg(F.count("*").alias("n")).collect()}


def test_readers_get_one_whole_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "weather")
    assert tables.read_weather(spark, path).count() == 0
    tables.write_weather(weather(spark, 1.0), path)
    before = tables.read_weather(spark, path)
    seen = []
    create = snapshots.Folder.create

    def watched(folder, name, text):
        # All files of the new version are there, and nobody sees them yet.
        seen.append(values(tables.read_weather(spark, path)))
        create(folder, name, text)

    monkeypatch.setattr(snapshots.Folder, "create", watched)
    tables.write_weather(weather(spark, 2.0), path)
    assert seen == [{(1.0, 60)}]
    assert values(before) == {(1.0, 60)}
    assert values(tables.read_weather(spark, path)) == {(2.0, 60)}
    assert values(tables.read_weather(spark, path, 1)) == {(1.0, 60)}


def test_a_failed_attempt_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "weather")
    tables.write_weather(weather(spark, 1.0), path)
    broken = weather(spark, 2.0).withColumn("AvgTmax", F.when(F.col("StationId") == "GM7", F.raise_error(F.lit("lost"))).otherwise(2.0))
    with pytest.raises(Exception, match="lost"):
        tables.write_weather(broken, path)
    assert values(tables.read_weather(spark, path)) == {(1.0, 60)}
    for value in (3.0, 4.0, 5.0):
        tables.write_weather(weather(spark, value), path)
    assert values(tables.read_weather(spark, path)) == {(5.0, 60)}
    # The failed attempt's files went with the versions of its time.
    names = snapshots.Folder(spark, path).names("data")
    assert [int(n.split("-")[0]) for n in names] == [3, 4]


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(5):
        assert snapshots.publish(spark.range(k), path, keep=3) == k + 1
    assert sorted(snapshots.versions(spark, path)) == [3, 4, 5]
    assert len(snapshots.Folder(spark, path).names("data")) == 3
    assert snapshots.read(spark, spark.range(0).schema, path).count() == 4


def test_of_two_writers_one_publishes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.publish(spark.range(1), path)
    create = snapshots.Folder.create

    def overtaken(folder, name, text):
        monkeypatch.setattr(snapshots.Folder, "create", create)
        snapshots.publish(spark.range(2), path)
        create(folder, name, text)

    monkeypatch.setattr(snapshots.Folder, "create", overtaken)
    with pytest.raises(snapshots.PublishConflict):
        snapshots.publish(spark.range(3), path)
    assert snapshots.read(spark, spark.range(0).schema, path).count() == 2


def test_a_version_may_be_made_from_the_one_before(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.range(0).schema
    snapshots.publish(spark.range(3), path)
    for _ in range(3):
        old = snapshots.read(spark, schema, path)
        snapshots.publish(old.union(old), path)
    assert snapshots.read(spark, schema, path).count() == 24


def scanned(df):
    """Rows that came out of the scans of Parquet files."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text, total = [plan], 0
    while text:
        node = text.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            text.append(node.executedPlan())
            continue
        if name.startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage")):
            text.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        text += [children.apply(k) for k in range(children.size())]
    return total


def test_readers_of_a_station_skip_the_others(spark, tmp_path):
    path = str(tmp_path / "weather")
    rows = spark.range(120_000).select(
        F.format_string("GM%05d", F.col("id") % 400).alias("StationId"), (F.col("id") % 12 + 1).cast("int").alias("Month"),
        (1970 + F.col("id") % 25).cast("int").alias("Year"), *[F.rand(k).alias(c) for k, c in enumerate(("AvgTmax", "AvgTmin", "AvgPrcp"))],
        F.lit("GM").alias("FIPS_code"), *[F.lit(1.0).alias(c) for c in ("LATITUDE", "LONGITUDE", "ELEVATION")],
    )
    tables.write_weather(rows, path, files=12, row_group=64 * 1024)
    table = tables.read_weather(spark, path)
    one = table.filter("FIPS_code = 'GM' and StationId = 'GM00123'").select("AvgPrcp")
    few = table.filter(F.col("StationId").isin("GM00007", "GM00123", "GM00399")).select("AvgPrcp")
    assert (one.count(), few.count()) == (300, 900)
    assert scanned(one) <= 120_000 / 20 and scanned(few) <= 3 * 120_000 / 20
