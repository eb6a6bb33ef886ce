import json

from meteorill.operators.observations import clean, parse_observations


def records(spark, lines):
    return spark.createDataFrame(
        [(line.encode() if line is not None else None, i) for i, line in enumerate(lines)],
        "value binary, offset bigint",
    )


def message(**fields):
    base = {"StationId": "CH1", "Date": 19700101, "Variable": "TMAX", "Value": 5}
    return json.dumps({**base, **fields})


def test_parse(spark, rows):
    lines = [
        message(),
        message(Extra=1),
        "garbage",
        message(Date="x"),
        message(Value=5.5),
        json.dumps({"StationId": "CH2"}),
        message(Q_Flag="X"),
        None,
    ]
    df = parse_observations(records(spark, lines), order="offset")
    got = {r.seq: (r.StationId, r.Date, r.Variable, r.Value, r.Q_Flag) for r in df.collect()}
    whole = ("CH1", 19700101, "TMAX", 5, None)
    assert got == {
        0: whole,
        1: whole,
        2: (None,) * 5,
        3: ("CH1", None, "TMAX", 5, None),
        4: ("CH1", 19700101, "TMAX", None, None),
        5: ("CH2", None, None, None, None),
        6: ("CH1", 19700101, "TMAX", 5, "X"),
        7: (None,) * 5,
    }


def test_order_is_optional(spark):
    assert "seq" not in parse_observations(records(spark, [message()])).columns


def test_clean(spark, rows):
    lines = [
        message(Date=19691231),
        message(),
        message(Variable="SNWD"),
        message(Q_Flag="X"),
        message(Q_Flag=""),
        message(M_Flag="M", Variable="PRCP"),
        "garbage",
    ]
    df = clean(parse_observations(records(spark, lines), order="offset"))
    assert df.columns == ["StationId", "Date", "Variable", "Value", "seq"]
    assert rows(df, "seq") == [(1,), (5,)]


def test_records_are_parsed_once(spark):
    df = clean(parse_observations(records(spark, [message()]), order="offset"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
