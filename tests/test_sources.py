"""Text files, tables, and the option maps of the connectors."""

import pytest

from meteorill.schemas import PARTIALS, RAW_RECORD, WEATHER
from meteorill.sources import jdbc, stream, tables, text


def test_stations_fixed_width(spark, tmp_path, rows):
    (tmp_path / "stations.txt").write_text(
        "\n".join(
            [
                "CH000000001  30.1234  110.5000   55.0    SOME NAME",
                "GM000000002             9.5000   12.5 TX",  # blank latitude
                "GR000000003 -38.0000  -23.5000 abc123456",  # unreadable elevation
                "BR000000004  -1.5",  # short line
                "IS000000005        5        6        7",
            ]
        )
    )
    got = rows(text.read_stations(spark, str(tmp_path / "stations.txt")))
    assert got == [
        ("BR000000004", -1.5, None, None),
        ("CH000000001", 30.1234, 110.5, 55.0),
        ("GM000000002", None, 9.5, None),
        ("GR000000003", -38.0, -23.5, None),
        ("IS000000005", 5.0, 6.0, 7.0),
    ]


def test_elevation_takes_nine_characters(spark, rows):
    line = "GM000000002  50.0000    9.5000   12.5 TX"
    frame = spark.createDataFrame([(line,)], "value string")
    assert line[31:40] == "  12.5 TX"
    assert rows(text.parse_stations(frame), "ELEVATION") == [(None,)]


def test_inventory(spark, tmp_path, rows):
    (tmp_path / "inventory.txt").write_text(
        "CH000000001  30.1000  110.5000 TMAX 1951 2020\n"
        "  GM000000002 -1 2.5 PRCP 1980   1999  \n"
        "GR000000003 x y SNWD 19a0\n"
    )
    got = rows(text.read_inventory(spark, str(tmp_path / "inventory.txt")))
    assert got == [
        ("CH000000001", 30.1, 110.5, "TMAX", 1951, 2020),
        ("GM000000002", -1.0, 2.5, "PRCP", 1980, 1999),
        ("GR000000003", None, None, "SNWD", None, None),
    ]


class Recorder:
    """Stands for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.kept = {}

    def format(self, name):
        self.kept["format"] = name
        return self

    def mode(self, name):
        self.kept["mode"] = name
        return self

    def options(self, **options):
        self.kept.update(options)
        return self

    def schema(self, schema):
        self.kept["schema"] = schema
        return self

    def load(self, path=None):
        self.kept["path"] = path
        return "loaded"

    def save(self):
        self.kept["saved"] = True


class Holder:
    def __init__(self):
        self.read = self.readStream = self.write = Recorder()


def test_kafka_options_reach_the_reader():
    holder = Holder()
    options = stream.kafka_options("host:1")
    assert stream.observation_stream(holder, options) == "loaded"
    assert holder.readStream.kept == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "CH,GM,GR,BR,IS",
        "startingOffsets": "earliest",
        "path": None,
    }
    assert stream.kafka_options("host:1", max_offsets=500_000)["maxOffsetsPerTrigger"] == "500000"


def test_records_are_numbered_by_offset_and_partition(spark, rows):
    records = spark.createDataFrame([(5, 0), (5, 3), (4, 9), (6, None)], "offset bigint, partition int")
    numbers = [r[0] for r in stream.numbered(records).select("seq").collect()]
    assert len(set(numbers)) == 4 and numbers[2] < numbers[0] < numbers[1] < numbers[3]
    assert rows(stream.numbered(records.drop("partition")), "seq") == [(4 << 12,), (5 << 12,), (5 << 12,), (6 << 12,)]


def test_jdbc_options_reach_reader_and_writer():
    options = jdbc.jdbc_options("jdbc:x", "Weather", "someone", "secret", fetchsize=1000)
    assert options == {
        "url": "jdbc:x", "dbtable": "Weather", "user": "someone", "password": "secret",
        "fetchsize": "1000",
    }
    holder = Holder()
    jdbc.read_jdbc(holder, options, years=(1970, 2020), partitions=50)
    assert holder.read.kept["format"] == "jdbc"
    assert holder.read.kept["partitionColumn"] == "Year"
    assert holder.read.kept["numPartitions"] == "50"
    plain = Holder()
    jdbc.read_jdbc(plain, options)
    assert "partitionColumn" not in plain.read.kept
    sink = Holder()
    jdbc.write_jdbc(sink, options)
    assert sink.write.kept["mode"] == "append" and sink.write.kept["saved"]


def test_file_stream_has_schema_and_path(spark, tmp_path):
    df = stream.observation_stream(spark, {}, "parquet", RAW_RECORD, str(tmp_path))
    assert df.isStreaming and df.schema == RAW_RECORD


def partial_row(batch, total, stream="main"):
    return ("CH1", 1, 2000, total, 1, 1, 1, 1, 1, "CH", 1.0, 2.0, 3.0, stream, batch)


def test_partials_replace_only_their_batch(spark, tmp_path, rows):
    path = str(tmp_path / "partials")
    for batch, total in [(0, 10), (1, 20), (1, 25)]:
        tables.write_partials(spark.createDataFrame([partial_row(batch, total)], PARTIALS), path)
    assert rows(tables.read_partials(spark, path), "batch_id", "SumTmax") == [(0, 10), (1, 25)]


def test_streams_do_not_replace_each_other(spark, tmp_path, rows):
    path = str(tmp_path / "partials")
    for name in ("one", "two"):
        tables.write_partials(spark.createDataFrame([partial_row(0, 10, name)], PARTIALS), path)
    assert rows(tables.read_partials(spark, path), "stream", "batch_id") == [("one", 0), ("two", 0)]


def test_compaction_survives_a_replay(spark, tmp_path, rows):
    path, compacted = str(tmp_path / "partials"), str(tmp_path / "compacted")
    data = [partial_row(b, 10 * (b + 1), s) for s in ("one", "two") for b in range(4)]
    tables.write_partials(spark.createDataFrame(data, PARTIALS), path)
    total = [("one", 100), ("two", 100)]

    def sums():
        table = tables.read_partials(spark, path, compacted)
        return rows(table.groupBy("stream").sum("SumTmax"))

    for up_to in (1, 1, 2):
        tables.compact_partials(spark, path, compacted, up_to)
        assert sums() == total
        assert tables.read_partials(spark, path, compacted).count() == 2 * (1 + 3 - up_to)
    tables.write_partials(spark.createDataFrame(data[:2], PARTIALS), path)
    assert sums() == total


def test_appended_partials_count_once(spark, rows):
    data = [partial_row(0, 10), partial_row(0, 10), partial_row(1, 20), partial_row(0, 10, "two")]
    table = jdbc.without_replays(spark.createDataFrame(data, PARTIALS))
    assert rows(table, "stream", "batch_id") == [("main", 0), ("main", 1), ("two", 0)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_absent_countries_leave_the_table(spark, tmp_path, mode):
    path = str(tmp_path / "weather")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for code in ("CH", "GM"):
            row = (f"{code}1", 1, 2000, 1.0, 2.0, 3.0, code, 1.0, 2.0, 3.0)
            tables.write_weather(spark.createDataFrame([row], WEATHER), path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert [r.FIPS_code for r in tables.read_weather(spark, path).collect()] == ["GM"]


def test_empty_tables_have_their_schema(spark, tmp_path):
    path = str(tmp_path / "empty")
    tables.write_partials(spark.createDataFrame([], PARTIALS), path)
    assert tables.read_partials(spark, path).count() == 0


def test_weather_is_replaced_not_doubled(spark, tmp_path):
    path = str(tmp_path / "weather")
    row = ("CH1", 1, 2000, 1.0, 2.0, 3.0, "CH", 1.0, 2.0, 3.0)
    for _ in range(2):
        tables.write_weather(spark.createDataFrame([row], WEATHER), path)
    again = tables.read_weather(spark, path)
    assert [tuple(r) for r in again.collect()] == [row]
    assert again.schema == WEATHER


def test_country_prunes_directories(spark, weather):
    plan = weather.filter("FIPS_code = 'GM' and Year = 2000").select("AvgPrcp")
    text_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(FIPS_code" in text_plan
    assert "EqualTo(Year,2000)" in text_plan


def test_workspace(spark):
    from meteorill.plans.workspace import new_folder

    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = new_folder(spark), new_folder(spark)
    assert first.startswith(shared) and first != second


def test_workspace_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from meteorill.plans.workspace import new_folder

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="spark://host"),
    )
    with pytest.raises(RuntimeError):
        new_folder(cluster)
