from meteorill.operators import profile

INVENTORY = "ID string, VARIABLE string, FIRSTYEAR int, LASTYEAR int"


def inventory(spark, data):
    return spark.createDataFrame(data, INVENTORY)


def test_years(spark, rows):
    df = inventory(
        spark,
        [("CH1", "TMAX", 1969, 1970), ("CH2", "TMAX", 1970, 1970), ("CH3", "TMAX", 1960, 1971)],
    )
    assert rows(profile.inventory_recent(df), "ID") == [("CH2",), ("CH3",)]


def test_stations(spark, rows):
    df = inventory(
        spark,
        [("CH", "TMAX", 1, 1), ("CH1", "TMAX", 1, 1), ("CH1", "TMIN", 1, 1), ("GM1", "TMAX", 1, 1),
         ("US1", "TMAX", 1, 1)],
    )
    assert rows(profile.stations_per_country(df)) == [
        ("BR", "Brazil", 0), ("CH", "China", 1), ("GM", "Germany", 1), ("GR", "Greece", 0),
        ("IS", "Israel", 0),
    ]


def test_top_five_with_ties(spark, rows):
    counts = {"A": 4, "B": 3, "C": 3, "D": 2, "F": 1, "E": 1, "G": 1}
    data = [(f"CH{i}", v, 1, 1) for v, n in counts.items() for i in range(n)]
    df = inventory(spark, data)
    assert rows(profile.top_variables(df), "rank", "VARIABLE", "n") == [
        (1, "A", 4), (2, "B", 3), (3, "C", 3), (4, "D", 2), (5, "E", 1),
    ]
    assert rows(profile.variable_counts(df), "VARIABLE", "n") == sorted(counts.items())


def test_share_is_among_the_top(spark, rows):
    data = [(f"CH{i}", v, 1, 1) for v, n in {"A": 2, "B": 1, "C": 1}.items() for i in range(n)]
    df = profile.variable_share(inventory(spark, data), k=2)
    assert rows(df, "country", "VARIABLE", "n", "pct", "label") == [
        ("China", "A", 2, 66.7, "66.7%\n(2)"), ("China", "B", 1, 33.3, "33.3%\n(1)"),
    ]
