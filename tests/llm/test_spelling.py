"""Words, neighbours and forms against brute force."""

import random
import re
from collections import Counter

import pytest
from meteorill.llm import spelling


def words_of(text, least=7):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [w.translate(lower) for w in re.findall("[A-Za-zÀ-ÿ]+", text or "") if len(w) >= least]


def one_away(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, factor=10):
    near = {w: [v for v in counts if one_away(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def result(df, **parameters):
    return sorted(tuple(r) for r in spelling.variants(df, **parameters).select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_roots_at_the_end_of_a_chain(spark):
    counts = {"wortende": 20_000, "wortend": 2_000, "wortenda": 50, "wortendab": 5, "anderes": 7, "anderese": 70}
    got = result(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    assert got == brute(counts)
    assert {r[0]: r[2] for r in got}["wortendab"] == "wortende"


@pytest.mark.parametrize("alphabet, shortest, longest", [("ab", 1, 9), ("abé", 7, 9), ("abcdefgh", 2, 6)])
def test_against_brute_force(spark, alphabet, shortest, longest):
    rng = random.Random(alphabet)
    counts = {"".join(rng.choice(alphabet) for _ in range(rng.randint(shortest, longest))): 2 ** rng.randint(1, 14) for _ in range(400)}
    got = result(spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3))
    assert got == brute(counts)
    assert any(r[1] for r in got)


def test_runs_of_one_letter_and_very_long_words(spark):
    base = "".join(random.Random(1).choice("abcdefgh") for _ in range(30_000))
    words = ["a" * k for k in range(7, 13)] + ["a" * 5000, "a" * 5001, "a" * 4999, base, base[:-1] + "z", "z" + base, base[:9000] + base[9001:], base[1:] + "q"]
    counts = {w: 3 * (k + 1) for k, w in enumerate(words)}
    assert result(spark.createDataFrame(list(counts.items()), "word string, n bigint")) == brute(counts)


def test_many_words_with_one_beginning(spark):
    """All words share a long beginning, and differ from one word in its last half."""
    rng = random.Random(3)
    counts = {"gemeinsam" + "".join(rng.choice("aeo") for _ in range(rng.randint(6, 8))): rng.randint(2, 500) for _ in range(900)}
    assert result(spark.createDataFrame(list(counts.items()), "word string, n bigint")) == brute(counts)


def test_words_of_odd_texts(spark, odd_docs, no_docs, make_docs):
    counts = Counter(w for r in odd_docs.collect() for w in words_of(r["text"]))
    expected = {w: n for w, n in counts.items() if n >= 2}
    assert {r["word"]: r["n"] for r in spelling.word_counts(odd_docs).collect()} == expected != {}
    assert result(spelling.word_counts(odd_docs)) == brute(expected)
    assert result(spelling.word_counts(no_docs)) == []
    docs = make_docs(["ÀÉlanÄÖÜß ÀÉlanÄÖÜß straßen× Straßen÷straßen", "x" * 3_000_000, ("wort" * 3 + " ") * 400_000])
    counts = Counter(w for r in docs.collect() for w in words_of(r["text"]))
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs, least_count=1).collect()} == counts


def test_changed_words(spark, make_docs):
    docs = make_docs(["Wortende wortende", "wortende anderes anderes"], [1, 2])
    got = spelling.word_counts(docs, change=lambda i: lambda w: w[1:] if i == 1 else w, least_count=1).collect()
    assert {r["word"]: r["n"] for r in got} == {"ortende": 2, "wortende": 1, "anderes": 2}
