"""The registered queries that SQL cannot express, over whole given tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import test_decontamination
import test_jaccard_join
import test_packing
import test_quality_rules
import test_secret_scan
import test_suffix_dedup
from meteorill.llm import secret_scan
from meteorill.llm.catalog import QUERIES
from meteorill.llm.oracle import oracle_sql
from pyspark.sql import functions as F

import corpus_pipeline

NUMBERS = range(1, 14)


@pytest.fixture(scope="module")
def documents(spark, small_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(NUMBERS)
    assert set(oracle_sql()) <= set(QUERIES)


def test_toxicity_on_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    found = QUERIES["op1_toxicity"](spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    counts = Counter((r["y"], r["toxic"]) for r in found.join(labels, "doc_id").collect())
    assert counts[0, True] <= 0.01 * counts[0, False] and counts[1, True] >= 5 * counts[1, False]


def test_resharding_law(spark, small_dir, documents):
    rows = QUERIES["op3_resharding"](spark, small_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    shards = {}
    for r in rows:
        data = (documents[r["doc_id"]]["text"] or "").encode()
        assert r["size"] == len(data) + 16 and r["text_crc32"] == zlib.crc32(data) and r["law"] == "bytes"
        shards.setdefault(r["shard"], []).append(r)
    assert set(shards) <= set(range(40))
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    sizes = [sum(r["size"] for r in shards.get(k, [])) for k in range(40)]
    assert max(sizes) - min(sizes) <= max(r["size"] for r in rows)


def test_quality_statistics(spark, small_dir, documents):
    for r in QUERIES["op5_quality_rules"](spark, small_dir).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == test_quality_rules.brute(documents[r["doc_id"]]["text"])
        assert r["base_failed"] == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_repeats_are_removed(spark, small_dir, documents):
    expected = test_suffix_dedup.brute([(i, r["text"]) for i, r in documents.items()])
    rows = QUERIES["op6_suffix_array_dedup"](spark, small_dir).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == {i: (*e[:3], hashlib.sha256(e[3]).hexdigest()) for _, i, e in expected}
    assert len(rows) == len(documents) and any(r["n_removed"] for r in rows)


def test_language_accuracy(spark, sf_dir):
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op7_language_id"](spark, sf_dir).join(langs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_packed_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").coalesce(1)
    padding, total, rows = test_packing.check(docs)
    got = QUERIES["op9_packing"](spark, small_dir)
    assert got.agg(F.sum("length")).first()[0] == total and padding < 0.02 * total


def test_secrets(spark, small_dir, documents):
    for r in QUERIES["op10_secret_scans"](spark, small_dir).collect():
        base = test_secret_scan.brute(documents[r["doc_id"]]["text"] or "")
        kinds = Counter(s[0] for s in base)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [kinds["assign"], kinds["access"], kinds["hex"]]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert {*filter(None, text.split(","))} <= set(spans)
        order = [(int(s.split(":")[1]), secret_scan.KINDS.index(s.split(":")[0])) for s in spans]
        assert order == sorted(order)


def test_stages_do_what_their_operators_find(spark, small_dir, documents, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, small_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    ids = {name: sorted(r["doc_id"] for r in rows) for name, rows in kept.items()}

    groups = test_jaccard_join.brute([(r["doc_id"], r["text"]) for r in kept["toxicity"]])
    assert ids["near_duplicates"] == sorted({c for _, _, c in groups})

    benchmark = [r["text"] for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    word_lists = [test_decontamination.words(t) for t in benchmark]
    windows = {tuple(w[s : s + 10]) for w in word_lists if w for s in range(max(1, len(w) - 9))}

    def hit(text):
        words = test_decontamination.words(text)
        return any(tuple(words[s : s + n]) in windows for n in {len(w) for w in windows} for s in range(len(words) - n + 1))

    assert ids["decontamination"] == sorted(r["doc_id"] for r in kept["near_duplicates"] if not hit(r["text"]))
    assert ids["secrets"] == ids["decontamination"]
    before = {r["doc_id"]: r["text"] for r in kept["decontamination"]}
    for r in kept["secrets"]:
        assert r["n_chars"] == len(r["text"])
        assert not test_secret_scan.brute(r["text"].replace("<secret>", "#"))
        if not secret_scan.base_spans(before[r["doc_id"]]):
            assert "<secret>" in r["text"] or r["text"] == before[r["doc_id"]]
    assert {r["doc_id"] for r in kept["packing"]} == set(ids["secrets"])
    by_doc = Counter()
    for r in kept["packing"]:
        by_doc[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert all(n == total for (_, n), total in by_doc.items())


def test_stages_take_odd_documents(spark, small_dir, odd_docs, no_docs, tmp_path):
    for start, docs in (("odd", odd_docs), ("none", no_docs)):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{start}-{name}")
            stage(spark, docs, small_dir).write.parquet(path)
            after = spark.read.parquet(path)
            assert name == "packing" or after.columns == docs.columns
            docs = after
        assert (docs.count() > 0) == (start == "odd")
