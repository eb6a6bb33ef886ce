import random

import numpy as np
import pytest
import xxhash
from llm_texts import prose
from meteorill.llm import suffix_dedup as sd


def checksum(text):
    """The number that orders texts of one id."""
    return int.from_bytes(xxhash.xxh64_digest(text.encode(), 42), "big", signed=True)


def brute(rows, length=100):
    """rows: (doc_id, text); fully equal rows are one document."""
    order = sorted({(i is not None, i or 0, checksum(t or ""), t or "") for i, t in rows})
    seen, kept = set(), {}
    for known, i, _, text in order:
        data = text.encode()
        gone = np.zeros(len(data), dtype=bool)
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                gone[s : s + length] = True
            seen.add(data[s : s + length])
        spans = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0)).reshape(-1, 2).tolist()
        kept[known, i, text] = (len(data), int(gone.sum()), len(spans), np.frombuffer(data, dtype=np.uint8)[~gone].tobytes(), spans)
    return sorted(((i is not None, i or 0, kept[i is not None, i or 0, t or ""]) for i, t in rows), key=repr)


def found(docs, **options):
    rows = sd.deduplicate(docs, **options).collect()
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]), [list(s) for s in r["spans"]])) for r in rows), key=repr)


@pytest.mark.parametrize("alphabet", [[97], [97, 98], [0, 1, 255], list(range(256))])
def test_suffix_order(alphabet):
    rng = random.Random(1)
    for size in [1, 2, 3, 50, 400]:
        data = np.array([rng.choice(alphabet) for _ in range(size)], dtype=np.uint8)
        raw = data.tobytes()
        order = sd.suffix_order(data, 104)
        assert sorted(order.tolist()) == list(range(size))
        prefixes = [raw[i : i + 104] for i in order]
        padded = sorted(raw[i : i + 104] for i in range(size))
        assert sorted(prefixes) == padded and all(a.ljust(104, b"\0") <= b.ljust(104, b"\0") for a, b in zip(prefixes, prefixes[1:], strict=False))
        common = sd.common_prefixes(data, order, 100, 7)
        for k in range(1, size):
            a, b = (raw[i : i + 100].ljust(100, b"\0") for i in order[k - 1 : k + 1])
            assert common[k] == next((j for j in range(100) if a[j] != b[j]), 100)


def texts():
    shared, other = prose(1, 60), prose(2, 60)
    edited = shared[:150] + "#" + shared[150:]
    return [
        shared,
        prose(3, 20) + shared + prose(4, 20),
        edited,
        shared[10:200] + other,
        other + shared[:99],
        other + shared[:100],
        other * 3,
        "a" * 1000,
        "a" * 99 + "b" + "a" * 100,
        "€" * 200,
        "\0" * 250 + shared[50:180],
        edited + edited[40:170],
    ]


@pytest.mark.parametrize("options", [{}, {"together": 1}, {"max_broadcast_rows": 0}, {"k": 90}])
def test_same_as_brute_force(make_docs, options):
    docs = make_docs(texts())
    assert found(docs, **options) == brute(list(enumerate(texts())))


def test_other_lengths(make_docs):
    docs = make_docs(texts())
    assert found(docs, length=40, k=10) == brute(list(enumerate(texts())), 40)


def test_long_texts_are_cut_without_a_seam(make_docs, monkeypatch):
    monkeypatch.setattr(sd, "STRETCH", 64)
    long = texts() + [prose(5, 500) + prose(1, 60)]
    docs = make_docs(long)
    assert found(docs) == brute(list(enumerate(long)))


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs) == brute(rows)
    assert found(no_docs) == []


def test_many_near_copies(make_docs):
    base = prose(9, 80)
    rng = random.Random(2)
    copies = []
    for _ in range(150):
        at = rng.randrange(len(base))
        copies.append(base[:at] + rng.choice("xyz") + base[at + 1 :])
    for together in (1, 16):
        assert found(make_docs(copies), together=together) == brute(list(enumerate(copies)))


def around(core, n, seed):
    """`n` texts with one core in different surroundings."""
    rng = random.Random(seed)

    def side():
        return "".join(rng.choice("abcdefghijklmnop") for _ in range(120))

    return [side() + core + side() for _ in range(n)]


@pytest.mark.parametrize("size", [64, 120])
def test_rows_for_each_text_do_not_change_where_a_part_is_split(make_docs, size):
    """A core that is too short to be removed makes no rows, and a longer one a few for each text, on both sides of the limit."""
    core = "".join(random.Random(7).choices("qrstuvwxyz", k=size))
    for n in (40, 100):
        texts = around(core, n, n)
        for together in (50, 1000):
            rows = sd.repeated_places(make_docs(texts), together=together).count()
            assert rows == 0 if size == 64 else n - 1 <= rows <= 8 * n, (n, together, rows)
        assert found(make_docs(texts), together=50) == brute(list(enumerate(texts)))


def test_two_texts_in_few_with_one_core(make_docs):
    """Cores of several lengths, in surroundings that some texts share in part."""
    core = "".join(random.Random(8).choices("qrstuvwxyz", k=64))
    texts = around(core, 40, 1)
    texts += [t[60:] + t[:30] for t in texts[:20]] + [t[:200] + "!" for t in texts[10:30]]
    for together in (1, 3, 20):
        assert found(make_docs(texts), together=together) == brute(list(enumerate(texts)))


def test_many_texts_of_one_id(make_docs):
    """All ids are missing: texts are told apart by themselves."""
    texts = [prose(1, 30) + prose(100 + k, 10) for k in range(60)]
    assert found(make_docs(texts, [None] * len(texts))) == brute([(None, t) for t in texts])


def test_anchors_are_those_of_the_runs(odd_docs):
    """The pass that counts anchors makes them alone, one for each run."""
    found = sd.anchor_rows(odd_docs, 100, 24)
    assert found.columns == ["anchor"]
    of_runs = sd.run_rows(odd_docs, 100, 24).select("anchor")
    assert found.count() == of_runs.count() > 0
    assert found.exceptAll(of_runs).isEmpty()
