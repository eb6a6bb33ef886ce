"""Codes, tables and scores of the language model against slow versions of themselves."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_texts import odd_texts, prose
from meteorill.llm import language_model as lm
from meteorill.llm.catalog import QUERIES
from pyspark.sql import functions as F


def small_model(texts):
    """A model of some texts, counted by simple loops."""
    counts = Counter(p for t in texts for p in lm.pieces_of(t))
    top = sorted(counts, key=lambda p: (-counts[p], p))[:20]
    pairs = np.zeros((256, 256))
    for p, n in counts.items():
        for a, b in zip(b"\xff" + p, p, strict=False):
            pairs[a, b] += n
    code = lm.Code(top, [counts[p] for p in top], pairs, sum(n for p, n in counts.items() if p not in top))
    bits = (12, 12, 12)
    tables = [np.zeros(2 << b, dtype=np.int64) for b in bits]
    for t in texts:
        known = lm.symbols(code, lm.pieces_of(t))
        for symbol, *hashes in zip(known.codes.tolist(), *[h.tolist() for h in known.hashes], strict=True):
            for d in code.flat[code.offsets[symbol] : code.offsets[symbol] + code.lengths[symbol]].tolist():
                for k, h in enumerate(hashes):
                    tables[k][2 * slot(h, d, bits[k]) + (d & 1)] += 1
    return lm.Model(code, bits, [lm.quantised(t) for t in tables])


def slot(context, decision, bits):
    node = ((decision >> 1) + 1) * 0x9E3779B1 & 0xFFFFFFFF
    return ((context ^ node ^ node >> 16) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - bits)


def slow_score(model, text):
    """One decision after the other, with one weight at a time."""
    known = lm.symbols(model.code, lm.pieces_of(text))
    weights = model.weights.astype(np.float64).copy()
    total, pending = 0.0, np.zeros_like(weights)
    for n, (symbol, *hashes) in enumerate(zip(known.codes.tolist(), *[h.tolist() for h in known.hashes], strict=True)):
        if n and n % lm.BLOCK == 0:
            weights += pending
            pending[:] = 0
        for d in model.code.flat[model.code.offsets[symbol] : model.code.offsets[symbol] + model.code.lengths[symbol]].tolist():
            found = [int(model.tables[k][slot(h, d, model.bits[k])]) for k, h in enumerate(hashes)]
            gate = 0
            for f in found:
                gate = gate * 4 + (f & 3)
            odds = [(f >> 2) / lm.UNIT for f in found] + [1.0]
            z = float(np.clip(sum(w * o for w, o in zip(weights[:, gate], odds, strict=True)), -12, 12))
            p = 1 / (1 + math.exp(-z))
            step = int(np.clip(np.rint(np.float32(z) * np.float32(2)), -16, 16)) + 16
            final = (p + float(model.refined[(d >> 1 & 255) * lm.STEPS + step])) / 2
            bit = d & 1
            total += math.log(min(max(final if bit else 1 - final, 1 / 8192), 1 - 1 / 8192))
            for k, o in enumerate(odds):
                pending[k, gate] += lm.RATE * (bit - p) * o
    return total


TEXTS = [prose(k, 40 + 60 * k).encode() for k in range(8)]


def test_codes_say_every_symbol():
    codes = lm._codes([5.0, 1.0, 0.5, 0.1, 7.0], 100)
    assert len({tuple(c) for c in codes}) == 5 and len(codes[4]) <= len(codes[3])
    assert sum(2.0 ** -len(c) for c in codes) == 1.0
    assert {d >> 1 for c in codes for d in c} == set(range(100, 104))
    assert lm._codes([3.0], 0) == [[]]


def test_pieces_are_the_text_again():
    for text in [*TEXTS, b"", b" \n\t ", b"x" * 1000, b"Aa  " * 100, *[(t or "").encode() for t in odd_texts()]]:
        pieces = lm.pieces_of(text)
        assert b"".join(pieces) == text.lower() + b"\xff"
        assert max(map(len, pieces)) <= lm.PIECE_WORD + 16


def test_probabilities_of_all_texts_sum_to_one():
    """Both outcomes of every decision together have all of the probability, so all texts do."""
    model = lm.fit(small_model(TEXTS[:5]), TEXTS[5:])
    got = lm.inputs(model, *(lambda k: (k.codes, k.hashes))(lm.symbols(model.code, lm.pieces_of(TEXTS[6]))))
    weights = list(model.weights)
    chance = 1 / (1 + np.exp(-lm.mixed(weights, got.gate, got.odds)))
    cells = lm._cells(got.node, lm.mixed(weights, got.gate, got.odds))
    one = (chance + model.refined[cells]) / 2
    assert ((0 < one) & (one < 1)).all()


@pytest.mark.parametrize("text", [TEXTS[0], TEXTS[6], TEXTS[7] * 6, b"", b"Unheard of: 0123 \xc3\xa9\xc3\xa9", b"a" * 4000])
def test_scores_equal_the_slow_version(text):
    model = lm.fit(small_model(TEXTS[:5]), TEXTS[5:])
    scorer = lm.Scorer(model)
    assert scorer.score([text])[0] == pytest.approx(slow_score(model, text), rel=1e-5)
    assert scorer.score([TEXTS[1], text, TEXTS[2]])[1] == pytest.approx(scorer.score([text])[0], rel=1e-12)


def test_stretches_change_nothing(monkeypatch):
    model = lm.fit(small_model(TEXTS[:5]), TEXTS[5:])
    text = b" ".join(TEXTS) * 3
    whole = lm.Scorer(model).score([text])[0]
    for stretch in (500, 5000):
        monkeypatch.setattr(lm, "STRETCH", stretch)
        assert lm.Scorer(model).score([text])[0] == pytest.approx(whole, rel=0.01)


def test_fitting_helps():
    model = small_model(TEXTS[:5])
    before = sum(lm.Scorer(model).score(TEXTS[5:]))
    assert sum(lm.Scorer(lm.fit(model, TEXTS[5:])).score(TEXTS[5:])) > before


def base(rows, learned):
    """Tokens and base score by hand."""
    tokens = {k: [*(t or "").encode().lower().split(), b" "] for k, t in enumerate(rows)}
    counts = Counter(w for k in learned for w in tokens[k])
    total, distinct = counts.total(), len(counts)
    return [(len(t), sum(counts[w] > 0 for w in t), sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t)) for t in tokens.values()]


@pytest.mark.parametrize("known", [1 << 18, 5])
def test_base_scores_of_odd_texts(spark, make_docs, monkeypatch, known):
    """The same whether all words are known to all tasks or the rarer ones meet the counts in a join."""
    monkeypatch.setattr(lm, "MAX_KNOWN", known)
    texts = [*odd_texts(), "long" * 40 + " word " + "long" * 40, "x" * 48 + " y", ("x" * 100 + " ") * 3, "word " * 30_000]
    docs = make_docs(texts)
    train = [k for k in range(len(texts)) if k % 3]
    learned = lm.learn(docs.where(F.col("doc_id").isin(train)))
    rows = {r["doc_id"]: r for r in lm.score(docs, learned).collect()}
    for k, (n, n_known, score) in enumerate(base(texts, train)):
        assert (rows[k]["n_tokens"], rows[k]["n_known"]) == (n, n_known)
        assert rows[k]["base_score"] == pytest.approx(score, rel=1e-9)
        assert rows[k]["score"] < 0 and rows[k]["bits_per_byte"] > 0
    assert learned.n_tokens == sum(len((texts[k] or "").split()) + 1 for k in train)


def test_tables_do_not_depend_on_partitions(spark, make_docs):
    docs = make_docs([prose(k, 200) for k in range(30)])
    scores = []
    for n in (1, 7):
        rows = lm.score(docs, lm.learn(docs.repartition(n))).collect()
        scores.append([r["score"] for r in sorted(rows, key=lambda r: r["doc_id"])])
    assert scores[0] == scores[1]


def test_odd_ids_repeated_rows_and_nothing_to_learn(spark, odd_docs, no_docs):
    learned = lm.learn(odd_docs)
    rows = lm.score(odd_docs, learned, ("doc_id", "word")).collect()
    assert len(rows) == odd_docs.count() and {r["word"] for r in rows} == {"x"}
    assert lm.score(no_docs, learned).count() == 0
    nothing = lm.learn(no_docs)
    assert (nothing.n_tokens, nothing.n_distinct) == (0, 0)
    assert all(r["n_known"] == 0 and r["score"] < 0 for r in lm.score(odd_docs, nothing).collect())


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_lm_scoring"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    ids = sorted(docs)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in ids}
    expected = base([docs[i] for i in ids], [k for k, i in enumerate(ids) if not held[i]])
    by_id = {r["doc_id"]: r for r in rows}
    for i, (n, known, score) in zip(ids, expected, strict=True):
        r = by_id[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"]) == (held[i], n, known)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
    unseen = [r for r in rows if r["held_out"]]
    # Of so few texts many words are new. The base takes the same for any of them; the model spells them, and codes the white space too.
    assert sum(r["score"] for r in unseen) > 1.25 * sum(r["base_score"] for r in unseen)
    shuffled = random.Random(1).sample("".join(docs[i] or "" for i in ids[:50]), 4000)
    learned = lm.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    odd = spark.createDataFrame([(1, "".join(shuffled)), (2, docs[ids[3]])], "doc_id bigint, text string")
    bits = {r["doc_id"]: r["bits_per_byte"] for r in lm.score(odd, learned).collect()}
    assert bits[1] > 1.3 * bits[2]


def test_mixers_learn_from_every_text(spark, make_docs):
    """Every decision of more texts than a sample would hold, long ones included, is met by one of the mixers; rows of one id share a half."""
    texts = [*(prose(k, 12) for k in range(450)), "", None, *[prose(1, 12)] * 20, prose(900, 12_000)]
    docs = make_docs(texts)
    model = small_model(TEXTS[:5])
    for shards in (1, 5):
        found = lm.averages(docs, model, model, shards).toPandas()
        met = found[found["at"] < 4 ** len(lm.MAX_BITS)]["n"].sum()
        known = [lm.symbols(model.code, lm.pieces_of((t or "").encode())) for t in texts]
        assert met == sum(len(lm.decisions(model.code, k.codes)[0]) for k in known)
    again = lm.averages(docs.repartition(7), model, model, 5).toPandas()
    assert again.sort_values("at").values.tolist() == found.sort_values("at").values.tolist()
    twice = docs.unionByName(docs).select("doc_id", lm._half().alias("half")).distinct()
    assert twice.count() == len(texts) and twice.select("half").distinct().count() == 2


def test_cut_is_pieces_of_all_texts():
    texts = [*TEXTS, b"", b" \n\t ", b" " * 100, b"x" * 48 + b" y", b"x" * 49, b"x" * 1000 + b" " * 40 + b"y", b"  lead", b"A" + b" " * 17, *[(t or "").encode() for t in odd_texts()]]
    data, starts, counts = lm.cut(texts)
    found = [data[a:b].tobytes() for a, b in zip(starts.tolist(), starts[1:].tolist(), strict=False)]
    assert found == [p for t in texts for p in lm.pieces_of(t)]
    assert counts.tolist() == [len(lm.pieces_of(t)) for t in texts]


def test_arrays_of_decisions_are_bounded(monkeypatch):
    """However long texts are, and however many, few decisions are worked on at a time: their arrays stay in the cache. That changes no score."""
    texts = [b" ".join(TEXTS) * 4, *TEXTS, b"zq" * 3000]
    model = small_model(TEXTS[:5])
    whole = lm.fit(model, texts)
    scores = lm.Scorer(whole).score(texts)
    seen = []
    hashed = lm._node_hash
    monkeypatch.setattr(lm, "_node_hash", lambda chosen: seen.append(len(chosen)) or hashed(chosen))
    for together in (1 << 15, lm.FIT_BLOCK):
        monkeypatch.setattr(lm, "TOGETHER", together)
        again = lm.fit(small_model(TEXTS[:5]), texts)
        assert (again.weights == whole.weights).all() and (again.refined == whole.refined).all()
        assert lm.Scorer(again).score(texts) == pytest.approx(scores, rel=1e-9)
        # A block of symbols is not divided.
        most = lm.BLOCK * int(model.code.lengths.max())
        assert max(seen) <= max(together, most)
        assert sum(seen) > 4 * together
        seen.clear()


def test_counts_of_portions_are_those_of_single_pieces(monkeypatch):
    """Tables from contexts that are counted once with their number, against one symbol after the other."""
    model = small_model(TEXTS[:5])
    code, bits = model.code, (12, 12, 12)
    known = [lm.symbols(code, lm.pieces_of(t)) for t in TEXTS]
    counts, slow = lm.Counts(bits, (1, 2)), lm.Counts(bits, (1, 2))
    monkeypatch.setattr(lm, "TOGETHER", 100)
    for k in known:
        counts.add(code, k.codes, dict(enumerate(k.hashes[1:], 1)), np.full(len(k.codes), 3))
        for symbol, one, two in zip(k.codes.tolist(), k.hashes[1].tolist(), k.hashes[2].tolist(), strict=True):
            for d in code.flat[code.offsets[symbol] : code.offsets[symbol] + code.lengths[symbol]].tolist():
                for p, h in ((1, one), (2, two)):
                    slow.tables[p][2 * slot(h, d, bits[p]) + (d & 1)] += 3
    for p in (1, 2):
        assert (counts.tables[p] == slow.tables[p]).all()
