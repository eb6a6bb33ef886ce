import random
import zlib

import numpy as np
import pytest
from llm_texts import odd_texts, prose
from meteorill.llm import packing
from tokenizers import Tokenizer

import public_tokenizers

PATH = public_tokenizers.path("byte_bpe_50k.json")


def cost(length, size):
    return 0 if size & (size - 1) == 0 else length - size


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_best(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 16, 20])
    places = sorted({0, *(rng.randrange(1, 120) for _ in range(40))})
    places = np.array([p for k, p in enumerate(places)])
    while (gaps := np.diff(places)).max() > length:
        places = np.sort(np.append(places, places[gaps.argmax()] + 1))
    penalty = np.array([rng.choice([0, 3, 9]) for _ in places])
    best = [0] + [10**9] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= length:
                best[j] = min(best[j], best[i] + penalty[i] + cost(length, int(places[j] - places[i])))
    cuts = packing.best_cuts(places, penalty, length)
    by_place = dict(zip(places.tolist(), penalty.tolist(), strict=True))
    total = sum(by_place[int(a)] + cost(length, int(b - a)) for a, b in zip(cuts, cuts[1:], strict=False))
    assert cuts[0] == 0 and cuts[-1] == places[-1] and total == best[-1]


def test_ids_are_those_of_the_vocabulary_file():
    exact, encode = Tokenizer.from_file(PATH), packing.tokenizer(PATH)
    texts = [t for t in odd_texts() if t is not None]
    texts += ["a<|endoftext|>b", "中文 \U0001f600‍", " \n \n\n  x", "it's we'll I'D", "x" * 5000, "1234567 ٣٤", "\x00\x01\x7f", " " * 3000 + "a"]
    rng = random.Random(1)
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x500), rng.randrange(0x4E00, 0x4F00)])) for _ in range(200)) for _ in range(40)]
    for text in texts:
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids, text[:40]


def check(docs, length=2048, **options):
    exact = Tokenizer.from_file(PATH)
    rows = [r.asDict() for r in packing.pack(docs, PATH, length=length, **options).collect()]
    expected = sorted((r["doc_id"] is None, r["doc_id"] or 0, [*exact.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in docs.collect())
    by_sequence = {}
    for r in rows:
        assert r["length"] > 0
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
        padding += cost(length, at)
    pool = {}
    for r in rows:
        pool.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    counts = sorted((i is None, i or 0, n * sum(r["start"] == 0 for r in group)) for (i, n), group in pool.items())
    assert sum(r["length"] for r in rows) == sum(len(e[2]) for e in expected)
    for missing, i, ids in expected:
        group = pool[None if missing else i, len(ids)]
        at = 0
        for r in sorted((r for r in group), key=lambda r: r["start"]):
            if r["start"] != at:
                continue
            if zlib.crc32(np.array(ids[at : at + r["length"]], dtype="<u4")) == r["ids_crc32"]:
                at += r["length"]
        assert at == len(ids)
    assert counts
    return padding, sum(r["length"] for r in rows), rows


def test_every_id_lies_in_one_piece_and_padding_is_small(make_docs):
    rng = random.Random(2)
    docs = make_docs([". ".join(prose(k * 10 + j, rng.randint(3, 30)) for j in range(rng.randint(1, 20))) for k in range(150)])
    padding, total, rows = check(docs.coalesce(1))
    assert padding < 0.05 * total
    cut = sum(r["start"] > 0 for r in rows)
    assert cut < 60


def test_small_spans_give_whole_results(make_docs):
    docs = make_docs([". ".join(prose(k * 10 + j, 12) for j in range(k % 15)) for k in range(60)] + ["y" * 20000, prose(1, 3000)])
    check(docs, span=500)
    check(docs, length=64, span=100)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert packing.pack(no_docs, PATH).count() == 0


def test_every_sentence_end_may_be_cut():
    ends = np.array([False, True])
    ids = np.random.default_rng(8).integers(0, 2, 300)
    places, cost = packing.cut_places(np.array([0, 150]), ids, ends, 64)
    price = dict(zip(places.tolist(), cost.tolist(), strict=True))
    for place in (np.flatnonzero(ids) + 1).tolist():
        assert price[place] == (0 if place in (0, 150, 300) else packing.SENTENCE_PENALTY)
