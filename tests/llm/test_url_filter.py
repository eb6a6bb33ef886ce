import random

from meteorill.llm import url_filter as uf
from pyspark.sql import functions as F


def test_membership_is_exact(spark):
    rng = random.Random(3)
    keys = [f"host{rng.randrange(10**9)}.example/{k}" for k in range(5000)]
    rows = [(k, n % 7 == 0) for n, k in enumerate(keys)]
    universe = spark.createDataFrame([*rows, *rows[:50], (None, True), ("", False)], "key string, listed boolean").repartition(3)
    for bits, hashes in ((10, 6), (2, 1)):
        cascade = uf.build_cascade(universe, bits_per_key=bits, hashes=hashes)
        assert len(cascade.levels) > 1
        wrong = universe.where(cascade.lists(F.col("key")) != F.col("listed"))
        assert wrong.count() == 0


def test_empty_lists(spark):
    nothing = spark.createDataFrame([], "key string, listed boolean")
    assert uf.build_cascade(nothing).levels == ()
    none = spark.createDataFrame([("a", False), ("b", None)], nothing.schema)
    assert none.where(uf.build_cascade(none).lists(F.col("key"))).count() == 0
    all_of_them = spark.createDataFrame([("a", True), ("a", False), ("b", True)], nothing.schema)
    assert all_of_them.where(uf.build_cascade(all_of_them).lists(F.col("key"))).count() == 3


def test_size_is_checked(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit(True).alias("listed"))
    try:
        uf.build_cascade(keys, max_bits=1024)
    except ValueError as error:
        assert "max_bits" in str(error)
    else:
        raise AssertionError


def test_urls_and_rules(spark):
    rules = [uf.Rule("allow", "org", "/"), uf.Rule("block", "example.org", "/es/"), uf.Rule("block", "com", "/de/")]
    urls = {
        "https://A.Example.org/es/1?x": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "x://y.org": ("y.org", "", None, "allow"),
        "http://com/de/#a": ("com", "/de/", "com/de/", "block"),
        "http://a.com/DE/": ("a.com", "/DE/", None, "block"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "a://b?c://d/e": ("b", "", None, "allow"),
        "line\nhttp://É.org/x\ny": ("É.org", "/x\ny", "org/", "allow"),
    }
    pages = spark.createDataFrame([(k, u, "h", "clash", "clash") for k, u in enumerate(urls)], "page_id int, url string, html string, host string, listed string")
    host = uf.url_host(F.col("url"))
    universe = pages.select(F.concat(host, uf.url_path(F.col("url"))).alias("key"), (host == "a.com").alias("listed"))
    rows = uf.judge(pages, uf.build_cascade(universe), rules).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows] == list(urls.values())
    assert uf.judge(pages.limit(0), uf.build_cascade(universe.limit(0)), rules).count() == 0


def test_no_join_and_no_python(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 3 == 0).alias("listed"))
    plan = keys.where(uf.build_cascade(keys).lists(F.col("key")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Exchange" not in plan
