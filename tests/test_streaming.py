import pytest
from pyspark.sql import functions as F

from meteorill.operators.stations import weather_from_bits, weather_from_daily, weather_from_partials, weather_from_sketches
from meteorill.plans import fixtures as fx
from meteorill.schemas import RAW_RECORD
from meteorill.sources import tables
from meteorill.sources.stream import admitted, numbered, observation_stream
from meteorill.streaming import ingest
from meteorill.streaming.progress import counted, follow


def write_records(spark, small_dir, path, files, *keys):
    spread = fx.obs(spark, small_dir).repartition(files, *keys)
    fx.records(spread).write.parquet(path)


def run(spark, base, start=ingest.start_ingest, admit=None, progress=None, **options):
    records = observation_stream(spark, admit or admitted(files=1), "parquet", RAW_RECORD, f"{base}/records")
    query = start(
        records, path=f"{base}/table", checkpoint=f"{base}/checkpoint", floor=fx.FLOOR,
        trigger={"availableNow": True}, progress=progress, **options,
    )
    query.awaitTermination()
    if progress is not None:
        progress.wait(query)
    return query


@pytest.fixture
def log(spark, tmp_path):
    log = follow(spark, str(tmp_path / "progress"))
    yield log
    spark.streams.removeListener(log)


@pytest.fixture(scope="module")
def expected(spark, small_dir):
    return sorted(map(str, fx.weather(spark, small_dir).collect()))


@pytest.mark.parametrize("files", [1, 2, 7])
def test_stream_equals_batch(spark, small_dir, tmp_path, expected, files):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", files, "StationId", "Date")
    stations = fx.stations(spark, small_dir)
    run(spark, base, stations=stations)
    partials = tables.read_partials(spark, f"{base}/table")
    assert partials.select("batch_id").distinct().count() == files
    assert sorted(map(str, weather_from_partials(partials, stations).collect())) == expected


def test_progress_outlives_the_query_and_its_buffer(spark, small_dir, tmp_path, log):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 4, "StationId", "Date")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        run(spark, base, stations=fx.stations(spark, small_dir), progress=log)
    finally:
        spark.conf.set(key, before)
    progress = tables.read_progress(spark, f"{base}/progress")
    assert sorted(r.batch_id for r in progress.collect()) == [0, 1, 2, 3]
    assert progress.agg(F.sum("input_rows")).first()[0] == fx.obs(spark, small_dir).count()
    assert progress.filter("duration_ms > 0").count() == 4


def test_progress_of_batches_without_records(spark, small_dir, tmp_path, log):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 1, "StationId", "Date")
    fx.records(fx.obs(spark, small_dir).limit(0)).coalesce(1).write.mode("append").parquet(f"{base}/records")
    run(spark, base, ingest.start_daily_ingest, progress=log)
    got = {r.batch_id: r.input_rows for r in tables.read_progress(spark, f"{base}/progress").collect()}
    assert got == {0: fx.obs(spark, small_dir).count(), 1: 0}


def test_a_query_that_has_ended_is_followed_from_its_start(spark, small_dir, tmp_path, log):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 2, "StationId", "Date")
    records = counted(numbered(observation_stream(spark, admitted(files=1), "parquet", RAW_RECORD, f"{base}/records")))
    query = records.writeStream.format("noop").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    log.follow(query, "late")
    log.wait(query)
    got = tables.read_progress(spark, f"{base}/progress")
    assert {(r.stream, r.batch_id) for r in got.collect()} == {("late", 0), ("late", 1)}
    assert got.agg(F.sum("input_rows")).first()[0] == fx.obs(spark, small_dir).count()


def test_the_source_is_read_once_for_each_batch(spark, small_dir, tmp_path, log):
    """Counting the records costs no further job: the stream's plan has read every row once."""
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 3, "StationId", "Date")
    query = run(spark, base, ingest.start_daily_ingest, progress=log)
    assert sum(p["numInputRows"] for p in query.recentProgress) == fx.obs(spark, small_dir).count()


@pytest.mark.parametrize("limit", ["files", "size"])
def test_a_backlog_is_taken_in_bounded_batches_in_order(spark, small_dir, tmp_path, log, limit):
    """Files that are all there are admitted a few at a time, in the order in which they came."""
    base, counts = str(tmp_path), []
    for k in range(5):
        some = fx.obs(spark, small_dir).filter(F.pmod(F.xxhash64("seq"), F.lit(5)) == k)
        fx.records(some.repartition(2)).write.mode("append").parquet(f"{base}/records")
        counts.append(some.count())
    admit = admitted(files=2) if limit == "files" else admitted(size=40_000)
    run(spark, base, ingest.start_daily_ingest, admit, log)
    got = [r.input_rows for r in tables.read_progress(spark, f"{base}/progress").orderBy("batch_id").collect()]
    assert sum(got) == sum(counts) and len(got) >= 5
    assert limit == "size" or got == counts
    with pytest.raises(ValueError):
        admitted(files=1, size=1)


@pytest.mark.parametrize("exact", [True, False])
def test_distinct_divisors_over_batches(spark, small_dir, tmp_path, exact):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 4, "StationId", "Date")
    run(spark, base, ingest.start_distinct_ingest, exact=exact)
    stations = fx.stations(spark, small_dir)
    read, weather = (tables.read_bit_partials, weather_from_bits) if exact else (tables.read_sketch_partials, weather_from_sketches)
    partials = read(spark, f"{base}/table")
    assert partials.select("batch_id").distinct().count() == 4
    whole = fx.weather(spark, small_dir, "distinct").collect()
    assert sorted(map(str, weather(partials, stations).collect())) == sorted(map(str, whole))


def test_stations_are_asked_for_in_every_batch(spark, small_dir, tmp_path):
    base, asked = str(tmp_path), []
    write_records(spark, small_dir, f"{base}/records", 3, "StationId", "Date")

    def stations():
        asked.append(len(asked))
        return fx.stations(spark, small_dir).limit(0) if len(asked) == 1 else fx.stations(spark, small_dir)

    run(spark, base, stations=stations)
    partials = tables.read_partials(spark, f"{base}/table")
    known = {r.batch_id: r.known for r in partials.groupBy("batch_id").agg(F.count("LATITUDE").alias("known")).collect()}
    assert asked == [0, 1, 2] and known[0] == 0 and known[1] > 0 and known[2] > 0


def test_station_that_turns_up_late(spark, small_dir, tmp_path, expected):
    """Batches before and after it became known make one row for each month."""
    base = str(tmp_path)
    stations = fx.stations(spark, small_dir)
    write_records(spark, small_dir, f"{base}/records", 2, "StationId", "Date")
    run(spark, base, stations=stations.limit(0))
    late = run_partials = tables.read_partials(spark, f"{base}/table")
    assert late.filter("LATITUDE is not null").count() == 0
    again = stations.unionByName(stations)
    assert sorted(map(str, weather_from_partials(run_partials, again).collect())) == expected


def test_restart_adds_only_new_records(spark, small_dir, tmp_path):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 2, "StationId", "Date")
    stations = fx.stations(spark, small_dir)
    run(spark, base, stations=stations)
    before = sorted(map(str, tables.read_partials(spark, f"{base}/table").collect()))
    run(spark, base, stations=stations)
    assert sorted(map(str, tables.read_partials(spark, f"{base}/table").collect())) == before


def test_replayed_batch_replaces_itself(spark, small_dir, tmp_path):
    path = str(tmp_path / "table")
    stations = fx.stations(spark, small_dir)
    observations = fx.clean_obs(spark, small_dir)
    for _ in range(2):
        tables.write_partials(ingest.batch_partials(observations, 3, stations), path)
    table = tables.read_partials(spark, path)
    assert table.count() == ingest.batch_partials(observations, 3, stations).count()


def test_two_streams_fill_one_table(spark, small_dir, tmp_path, expected):
    base = str(tmp_path)
    stations = fx.stations(spark, small_dir)
    for k, name in enumerate(("one", "two")):
        half = fx.obs(spark, small_dir).filter(F.col("Date") % 2 == k)
        fx.records(half.coalesce(1)).write.parquet(f"{base}/{name}/records")
        records = observation_stream(spark, {}, "parquet", RAW_RECORD, f"{base}/{name}/records")
        ingest.start_ingest(
            records, stations, f"{base}/table", f"{base}/{name}/checkpoint", floor=fx.FLOOR,
            trigger={"availableNow": True}, stream=name,
        ).awaitTermination()
    partials = tables.read_partials(spark, f"{base}/table")
    assert sorted(map(str, weather_from_partials(partials, stations).collect())) == expected


def test_daily_ingest_does_not_depend_on_batches(spark, small_dir, tmp_path, expected):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 5, "seq")
    run(spark, base, start=ingest.start_daily_ingest)
    daily = tables.read_daily(spark, f"{base}/table")
    assert daily.select("batch_id").distinct().count() == 5
    got = weather_from_daily(daily, fx.stations(spark, small_dir))
    assert sorted(map(str, got.collect())) == expected


def test_another_sink(spark, small_dir, tmp_path):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 1, "StationId", "Date")
    seen = []

    def write(df, path):
        seen.append((df.columns, path, df.count()))

    run(spark, base, stations=fx.stations(spark, small_dir), write=write)
    assert seen[0][1] == f"{base}/table" and "countTmax" in seen[0][0]


def test_a_failing_sink_fails_the_query(spark, small_dir, tmp_path):
    base = str(tmp_path)
    write_records(spark, small_dir, f"{base}/records", 1, "StationId", "Date")

    def broken(df, path):
        raise OSError("no database")

    with pytest.raises(Exception, match="no database"):
        run(spark, base, stations=fx.stations(spark, small_dir), write=broken)


def test_files_of_a_micro_batch_grow_with_the_records(spark, tmp_path, monkeypatch):
    """Tasks that write and read a part's records are bounded; each part is still one batch."""
    from meteorill.plans import catalog

    small = "/root/testdata/sf0.001"
    assert catalog._files(spark, small) == catalog.FILES
    monkeypatch.setattr(catalog, "FILE_RECORDS", 100)
    n = spark.read.parquet(f"{small}/lineitem.parquet").count()
    files = catalog._files(spark, small)
    assert files == -(-n // 400) > catalog.FILES
    catalog._by_day(spark, small, str(tmp_path))
    names = [r["f"] for r in spark.read.parquet(f"{tmp_path}/records").select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(names) == 4 * files
    base = catalog._ingest(spark, small)
    batches = spark.read.parquet(f"{base}/partials").select("batch_id", "Year", "Month").distinct()
    assert sorted(r["batch_id"] for r in batches.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
