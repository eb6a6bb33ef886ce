import random
import re

import pytest
from llm_texts import prose
from meteorill.llm import jaccard_join as jj


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(sets[k]), least.get(root(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=repr)


def found(docs, **options):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jj.near_duplicates(docs, **options).collect()), key=repr)


def corpus():
    rng = random.Random(4)
    texts = []
    for family in range(6):
        base = prose(100 + family, 80).split()
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    passage = prose(7, 60)
    texts += [passage + " " + prose(200 + k, 8 + 2 * k) for k in range(20)]
    chain = prose(300, 60).split()
    for k in range(12):
        texts.append(" ".join(chain))
        chain = [*chain[1:], f"next{k}"]
    return texts


@pytest.mark.parametrize("options", [{}, {"max_rounds": 0}, {"common": 2, "max_rounds": 1}])
def test_same_as_brute_force(make_docs, options):
    texts = corpus()
    assert found(make_docs(texts), **options) == brute(list(enumerate(texts)))


def test_thresholds_are_exact(make_docs):
    base = prose(11, 104).split()
    texts = [" ".join(base)] + [" ".join([*base[: 104 - k], *(f"z{k}{j}" for j in range(k))]) for k in range(5, 20)]
    rows = list(enumerate(texts))
    docs = make_docs(texts)
    pairs = jj.Order({})
    assert pairs.keys(jj.shingles(texts[0])).shape == (100,)
    assert found(docs) == brute(rows)


@pytest.mark.parametrize(("inner", "outer"), [(80, 100), (82, 100), (400, 500)])
def test_sets_inside_others(make_docs, inner, outer):
    texts = []
    for pair in range(40 if outer < 500 else 12):
        words = [f"w{inner}x{pair}x{k}" for k in range(outer + 4)]
        texts += [" ".join(words[: inner + 4]), " ".join(words)]
    assert found(make_docs(texts)) == brute(list(enumerate(texts)))


def test_small_and_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs) == brute(rows)
    assert found(no_docs) == []


def test_short_texts(make_docs):
    texts = ["a", "A", "a b", "a\tb", "a b c d e", "a b c d e f", "a b c d e f g h i j", "a b c d e f g h i k", "a b c d", " "]
    assert found(make_docs(texts)) == brute(list(enumerate(texts)))


def test_shuffled_where_not_small(make_docs, monkeypatch):
    monkeypatch.setattr(jj, "bounded", lambda df, rows, most: df.hint("merge"))
    texts = corpus()[:40]
    assert found(make_docs(texts)) == brute(list(enumerate(texts)))


def test_one_of_each_group_stays(odd_docs, make_docs):
    for docs in (odd_docs, make_docs(corpus())):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        expected = brute(rows)
        kept = jj.keep_one(docs)
        assert kept.columns == docs.columns
        ids = [r["doc_id"] for r in kept.collect()]
        alone = [i for i, n, _ in expected if not n]
        groups = {c for _, n, c in expected if n}
        assert sorted(map(repr, ids)) == sorted(map(repr, [*alone, *groups]))
