import random
import re
from collections import Counter

from llm_texts import prose
from meteorill.llm import quality_rules as qr
from pyspark.sql import functions as F


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts = Counter(windows)
    repeated = {p for k, w in enumerate(windows) if counts[w] > 1 for p in range(k, k + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def test_statistics_are_those_of_brute_force(make_docs, odd_docs):
    rng = random.Random(5)
    more = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    more += [prose(7, 9) + " " + prose(7, 9), "a\tb\x0bc\x0cd\re\n" * 3, "#a*$é%&|<>\n#a*$é%&|<>"]
    docs = make_docs(more).unionByName(odd_docs)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    expected = sorted((r["doc_id"] is None, r["doc_id"] or 0, brute(r["text"])) for r in docs.collect())
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r[n] for n in names)) for r in qr.text_statistics(docs).collect())
    assert got == expected


def test_rules_find_junk_and_keep_prose(spark, make_docs):
    def junk(k):
        return " ".join(w + "***" for w in prose(k, 40).split()) if k % 2 else prose(k, 40).upper()

    docs = make_docs([junk(k) if k % 4 == 0 or k % 8 == 1 else prose(k, 40) for k in range(400)])
    bad = ((F.col("doc_id") % 4 == 0) | (F.col("doc_id") % 8 == 1)).alias("bad")
    statistics = qr.text_statistics(docs)
    rules = qr.learn(statistics.where("doc_id < 300").select("*", bad))
    judged = qr.judge(statistics, rules).select("*", bad)
    assert rules.rules and judged.where("kept = bad").count() <= 12
    as_sql = judged.select(*statistics.columns, "kept", *qr.features())
    assert as_sql.where(F.expr(rules.sql()) != F.col("kept")).count() == 0
    again = qr.learn(statistics.repartition(5).where("doc_id < 300").select("*", bad))
    assert again == rules


def test_labels_without_meaning_reject_nothing(make_docs):
    statistics = qr.text_statistics(make_docs([prose(k, 40) for k in range(200)]))
    rules = qr.learn(statistics.select("*", (F.xxhash64("doc_id") % 3 == 0).alias("bad")))
    assert qr.judge(statistics, rules).where("not kept").count() <= 10


def test_odd_rows(odd_docs, no_docs):
    statistics = qr.text_statistics(odd_docs)
    rules = qr.learn(statistics.select("*", F.lit(None).cast("boolean").alias("bad")))
    assert rules.rules == () and rules.sql() == "true"
    judged = qr.judge(statistics, rules).collect()
    assert len(judged) == odd_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in judged if r["n_words"] < 10)
    nothing = qr.text_statistics(no_docs)
    assert nothing.count() == 0 and qr.learn(nothing.select("*", F.lit(True).alias("bad"))).rules == ()


def test_no_python(odd_docs):
    plan = qr.judge(qr.text_statistics(odd_docs), qr.DecisionList(()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
