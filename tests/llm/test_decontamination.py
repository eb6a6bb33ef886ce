import random
import re

import pytest
from llm_texts import prose
from meteorill.llm import decontamination as dc


def words(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        mine, hits, ids = words(text), set(), set()
        for item_id, item in items:
            theirs = words(item)
            size = min(window, len(theirs))
            for s in range(len(theirs) - size + 1 if theirs else 0):
                for d in range(len(mine) - size + 1):
                    if mine[d : d + size] == theirs[s : s + size]:
                        hits |= {*range(d, d + size)}
                        ids.add(str(item_id) if item_id is not None else "")
        out.append((doc_id, len(mine), sorted(hits), sorted(ids)))
    return sorted(out, key=repr)


def found(docs, items, spark, **options):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = dc.decontaminate(docs, benchmark, **options).collect()
    return sorted(((r["doc_id"], r["n_words"], r["hits"], r["item_ids"]) for r in rows), key=repr)


ITEMS = [(0, prose(50, 30)), (1, "one two three"), (2, None), (3, ""), (4, prose(1, 14)), (4, prose(1, 14)), (None, "word"), (5, "the the the the the the the the the the the the")]


@pytest.mark.parametrize("rarest", [1, 2, 3, 10])
def test_same_as_brute_force(spark, odd_docs, rarest):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs, ITEMS, spark, rarest=rarest) == brute(docs, ITEMS)


def test_partial_and_hidden_passages(spark, make_docs):
    item = prose(50, 30).split()
    texts = [
        "x " + " ".join(item[5:25]) + " y",
        " ".join(item[:9]),
        "; ".join(item).upper(),
        " ".join(item[20:]) + " " + " ".join(item[:12]),
        "the " * 30,
        " ".join([*item[:4], "gap", *item[4:]]),
    ]
    docs = make_docs(texts)
    assert found(docs, ITEMS, spark) == brute(list(enumerate(texts)), ITEMS)


def test_empty_tables(spark, odd_docs, no_docs):
    assert found(no_docs, ITEMS, spark) == []
    assert all(not r[2] for r in found(odd_docs, [], spark))


def test_shuffled_where_not_small(spark, odd_docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    index = dc.build_index(odd_docs, benchmark, max_broadcast_rows=0)
    near = dc.near_candidates(index, max_broadcast_rows=0)
    rows = dc.matches(odd_docs, index, dc.candidates(index, max_broadcast_rows=0), near, max_broadcast_rows=0).collect()
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(((r["doc_id"], r["n_words"], r["hits"], r["item_ids"]) for r in rows), key=repr) == brute(docs, ITEMS)


def brute_near(docs, items, slack=3, window=10):
    out = []
    for doc_id, text in docs:
        mine, ids = words(text), set()
        for item_id, item in items:
            theirs = words(item)
            size = min(window, len(theirs))
            for start in range(len(theirs) - size + 1 if theirs else 0):
                own = theirs[start : start + size]
                if set(own) <= set(mine) and any(
                    all(w in mine[max(0, s + p - slack) : max(0, s + p + slack + 1)] for p, w in enumerate(own)) for s in range(-slack - size, len(mine) + slack + 1)
                ):
                    ids.add(str(item_id) if item_id is not None else "")
        out.append((doc_id, sorted(ids)))
    return sorted(out, key=repr)


def found_near(docs, items, spark, **options):
    rows = dc.decontaminate(docs, spark.createDataFrame(items, "item_id bigint, text string"), **options).collect()
    assert all(set(r["item_ids"]) <= set(r["near_ids"]) for r in rows)
    return sorted(((r["doc_id"], r["near_ids"]) for r in rows), key=repr)


def edited(item, rng):
    """A passage with words put in, left out of the way, or swapped."""
    out = list(item)
    for _ in range(rng.randint(1, 6)):
        at = rng.randrange(len(out) - 1)
        if rng.random() < 0.5:
            out.insert(at, rng.choice(["so", "the", *item]))
        else:
            out[at], out[at + 1] = out[at + 1], out[at]
    return out


@pytest.mark.parametrize("slack, rarest", [(3, 2), (1, 2), (3, 10), (0, 1)])
def test_near_matches_against_brute_force(spark, make_docs, slack, rarest):
    rng = random.Random(slack + rarest)
    item = prose(50, 30).split()
    texts = [" ".join(["x"] * rng.randint(0, 30) + edited(item[k:], rng) + ["y"] * rng.randint(0, 9)) for k in range(0, 24, 2)]
    texts += ["word", "three two one", "one x x x x two three", " ".join(item[::2]), " ".join(reversed(item)), "the " * 9, "the " * 7, None]
    docs = make_docs(texts)
    got = found_near(docs, ITEMS, spark, slack=slack, rarest=rarest)
    assert got == brute_near(list(enumerate(texts)), ITEMS, slack)
    assert any("0" in ids for _, ids in got)


def test_near_matches_in_odd_rows(spark, odd_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found_near(odd_docs, ITEMS, spark) == brute_near(docs, ITEMS)


def test_words_put_in_and_swapped_are_near_and_not_exact(spark, make_docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    swapped = [*item[:4], "so", item[5], item[4], *item[6:]]
    docs = make_docs([" ".join(swapped), " ".join([item[0], *("far " * 40).split(), *item[1:]]), "nothing here"])
    rows = dc.decontaminate(docs, spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["item_ids"], r["near_ids"]) for r in rows} == {0: ([], ["7"]), 1: ([], []), 2: ([], [])}


def test_keep_clean(spark, odd_docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    matches = dc.decontaminate(odd_docs, benchmark)
    kept = dc.keep_clean(odd_docs, matches)
    assert kept.columns == odd_docs.columns
    assert kept.count() == matches.where("size(hits) = 0").count()


def test_no_python(spark, odd_docs):
    plan = dc.decontaminate(odd_docs, spark.createDataFrame(ITEMS, "item_id bigint, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
