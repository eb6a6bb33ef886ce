"""The stateful stream: days cut over batches, restarts, late records, and what the state holds."""

import random

import pytest
from pyspark.sql import functions as F

from meteorill.operators import monthly
from meteorill.plans import fixtures as fx
from meteorill.schemas import RAW_RECORD
from meteorill.sources import tables
from meteorill.sources.stream import admitted, observation_stream
from meteorill.streaming.monthly_state import start_monthly_state

OBS = "StationId string, Date int, Variable string, Value int, seq bigint"
FLAGS = {"M_Flag": None, "Q_Flag": None, "S_Flag": None, "ObsTime": "0700"}


def write(spark, base, rows):
    df = spark.createDataFrame(rows, OBS)
    df = df.withColumns({k: F.lit(v).cast("string") for k, v in FLAGS.items()})
    fx.records(df.coalesce(1)).write.mode("append").parquet(f"{base}/records")


def run(spark, base, lateness="30 days"):
    records = observation_stream(spark, admitted(files=1), "parquet", RAW_RECORD, f"{base}/records").drop("partition")
    query = start_monthly_state(
        records, f"{base}/monthly", f"{base}/checkpoint", floor=19700101, trigger={"availableNow": True}, lateness=lateness
    )
    query.awaitTermination()
    return query


def result(spark, base):
    columns = ["StationId", "Month", "Year", *monthly.SUMS, *monthly.COUNTS]
    return sorted(map(str, tables.read_monthly(spark, f"{base}/monthly").select(columns).collect()))


def whole(spark, rows):
    columns = ["StationId", "Month", "Year", *monthly.SUMS, *monthly.COUNTS]
    return sorted(map(str, monthly.monthly_partials(spark.createDataFrame(rows, OBS)).select(columns).collect()))


@pytest.mark.parametrize("seed, restart", [(1, False), (2, True)])
def test_days_cut_over_batches(spark, tmp_path, seed, restart):
    """Repeated values of a day in different batches, the first of them often last; a restart in between changes nothing."""
    r, base = random.Random(seed), str(tmp_path)
    rows = [
        (r.choice(["CH1", "CH1", "GM2", "GR3"]), r.choice([19991231, 20000101, 20000102, 20000131, 20000201]), r.choice(["TMAX", "TMIN", "PRCP"]), r.choice([None, *range(-20, 20)]), seq)
        for seq in range(400)
    ]
    r.shuffle(rows)
    for k in range(4):
        write(spark, base, rows[k::4])
        if restart:
            run(spark, base, "60 days")
    run(spark, base, "60 days")
    assert result(spark, base) == whole(spark, rows)


def test_rows_go_out_only_when_a_month_changes(spark, tmp_path):
    base = str(tmp_path)
    write(spark, base, [("CH1", 20000101, "TMAX", 5, 1), ("CH1", 20000201, "TMAX", 7, 2)])
    write(spark, base, [("CH1", 20000101, "TMAX", 9, 3), ("CH1", 20000202, "TMAX", 1, 4)])
    run(spark, base)
    sent = spark.read.parquet(f"{base}/monthly").select("batch_id", "Month", "SumTmax").collect()
    assert sorted(map(tuple, sent)) == [(0, 1, 5), (0, 2, 7), (1, 2, 8)]


def test_state_is_bounded_and_late_records_are_dropped(spark, tmp_path):
    """A year is forgotten when the watermark has passed its end; what comes for it then is not counted."""
    base = str(tmp_path)
    years = list(range(1990, 2000))
    for year in years:
        write(spark, base, [(f"CH{k}", year * 10000 + 701, "TMAX", k, year * 100 + k) for k in range(20)])
    query = run(spark, base)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(states) <= 2 * 20 and states[-1] <= 20
    before = result(spark, base)
    assert len(before) == 20 * len(years)
    write(spark, base, [("CH1", 19910702, "TMAX", 1000, 5)])
    run(spark, base)
    assert result(spark, base) == before


def test_bad_days_and_stations_do_not_stop_the_stream(spark, tmp_path):
    base = str(tmp_path)
    good = [("CH1", 20000101, "TMAX", 5, 1)]
    write(spark, base, [*good, (None, 20000101, "TMAX", 5, 2), ("CH1", 20001399, "TMAX", 5, 3), ("CH1", None, "TMAX", 5, 4)])
    run(spark, base)
    assert result(spark, base) == whole(spark, good)


def test_calls_and_states_do_not_grow_with_the_stations(spark, tmp_path):
    """One state, and one call, for a group of stations and a year; the sums are those of each station."""
    r, base = random.Random(3), str(tmp_path)
    rows = [(f"CH{seq % 3000}", r.choice([20000101, 20000102, 20000301]), r.choice(["TMAX", "TMIN"]), r.choice([None, *range(-20, 20)]), seq) for seq in range(9000)]
    r.shuffle(rows)
    for k in range(2):
        write(spark, base, rows[k::2])
    query = run(spark, base, "100 days")
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(states) <= 1024
    assert result(spark, base) == whole(spark, rows)
