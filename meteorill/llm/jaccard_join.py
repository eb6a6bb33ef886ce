"""Exact n-gram Jaccard join of documents, by vertical partitioning.

A document is the set of its word n-grams, hashed to 64 bits. All n-grams have one global order:
rare ones by hash, then those that many documents share, by how many; it says which n-grams are the beginning of a
set. For counting, the n-grams are cut vertically into fragments, at equal distances of their hashes, so that
common ones stand among the others: a pair's overlap is counted in each fragment by itself and summed.

Which pairs are counted: two linked sets share an n-gram in the beginning of each, as far as that
order and the threshold say; what such beginnings share bounds a pair's overlap, and most pairs fall
to that bound. Of the others those are counted first that join many sets, one partner for each set
and round; sets that are connected by then need no more. When a round joins nothing new, every pair
left between sets not connected so far is counted. No link between different groups is lost, and a
large group of near copies costs about as many counts as it has members.

Equal sets are one class from the start. A null or empty text, or one without words, has no n-grams,
is linked with nothing and keeps its own id. With fewer than n words the whole sequence is one
n-gram. The component of rows whose ids are all null is null. Sets are taken as equal if a 64-bit
digest and their size are. Rows that occur repeatedly are in one class; of equal ids with different texts each is a document.
Very long texts are one set like any other, held by one task at a time. Ties in the order of n-grams change no link. Further
columns, whatever their names, play no part; an empty table has an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.tables import bounded, stored, text_or_empty

N = 5
#: A pair is linked from this share of intersection to union, in percent.
PERCENT = 80
FRAGMENTS = 4
#: From so many documents on, as far as tasks see it, an n-gram counts as common and goes to the end of the order.
COMMON = 64
#: Common n-grams that are known to all tasks; which ones these are changes the order, not the result.
MAX_COMMON = 1 << 17
#: N-grams that a task counts at a time.
COUNTED = 1 << 21
#: Rounds of one partner for each set before all remaining pairs are counted.
MAX_ROUNDS = 2
#: Documents whose n-grams a task holds at a time.
ROWS = 500
MAX_BROADCAST_ROWS = 500_000

MULTIPLIER = 0x9E3779B97F4A7C15


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, and a random number for each byte."""
    odd = np.uint64(MULTIPLIER)
    inverse = np.uint64(pow(MULTIPLIER, -1, 1 << 64))
    size = 1 << bits
    up, down = np.ones(size, dtype=np.uint64), np.ones(size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        up[1:], down[1:] = odd, inverse
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
    table = np.frombuffer(hashlib.shake_256(b"bytes").digest(2048), dtype="<u8").copy()
    return up, down, table


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Hashes of the distinct word n-grams of the whole text, ascending.

    Bytes from word i to the end of word i + n - 1 of the words joined by single spaces are one
    n-gram; differences of a running sum hash all of them at once.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    up, down, table = _powers(max(16, len(data).bit_length()))
    with np.errstate(over="ignore"):
        running = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=running[1:])
        breaks = np.flatnonzero(data == 32)
        starts, ends = np.concatenate([[0], breaks + 1]), np.append(breaks, len(data))
        span = min(n, len(words)) - 1
        starts, ends = starts[: len(starts) - span], ends[span:]
        return np.unique(_mixed((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64)))


def digest(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "big", signed=True)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            yield part, [shingles(t) for t in part["text"].to_pylist()]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def document_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, class, n) of every document, stored; equal sets have equal class and n."""

    def run(batches):
        for batch, sets in _texts(batches):
            kept = batch.drop_columns("text")
            kept = kept.append_column("class", pa.array([digest(s) for s in sets], pa.int64()))
            yield kept.append_column("n", pa.array([len(s) for s in sets], pa.int64()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text_or_empty().alias("text"))
    return stored(texts.mapInArrow(run, f"doc_id {kind}, text_hash bigint, class bigint, n bigint"))


def common_shingles(docs: DataFrame, *, common: int = COMMON, most: int = MAX_COMMON) -> dict[int, int]:
    """N-grams of many documents with their counts.

    Tasks count what they see and pass on what they have seen more than once; sums are a lower bound.
    They decide the order only, which may be any.
    """

    def run(batches):
        pool: list[np.ndarray] = []
        seen: set[int] = set()

        def counted():
            values, counts = np.unique(np.concatenate(pool), return_counts=True)
            many = counts > 1
            return _batch(token=values[many].view(np.int64), count=counts[many])

        size = 0
        for _, sets in _texts(batches):
            for s in sets:
                if len(s) and (key := digest(s)) not in seen:
                    seen.add(key)
                    pool.append(s)
                    size += len(s)
            if size >= COUNTED:
                yield counted()
                pool, size, seen = [], 0, set()
        if pool:
            yield counted()

    found = docs.select(text_or_empty().alias("text")).mapInArrow(run, "token bigint, count bigint")
    often = found.groupBy("token").agg(F.sum("count").alias("count")).where(F.col("count") >= common)
    return {r["token"]: r["count"] for r in often.orderBy(F.desc("count"), "token").limit(most).collect()}


class Order:
    """The global order of n-grams: one number for each, equal ones only for ties by chance."""

    def __init__(self, common: dict[int, int]):
        tokens = np.array(list(common), dtype=np.int64).view(np.uint64)
        counts = np.array(list(common.values()), dtype=np.int64)
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        keys = (hashes >> np.uint64(2)).astype(np.int64)
        if len(self.tokens) and len(hashes):
            at = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
            hit = self.tokens[at] == hashes
            late = (np.int64(1) << 62) + (np.minimum(self.counts[at[hit]], (1 << 30) - 1) << 31) + (hashes[hit] >> np.uint64(33)).astype(np.int64)
            keys[hit] = late
        return keys


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """How many n-grams at the beginning of a set of n must hold one that any linked set shares."""
    return n - (percent * n + 99) // 100 + 1


def prefixes(docs: DataFrame, order: Order) -> DataFrame:
    """(token, class, n, place, size, last) for the beginning of each set: place from 1 in it, its size
    and the order's number of its last n-gram. Stored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        for _, sets in _texts(batches):
            found: list[tuple] = []
            for s in sets:
                if not len(s):
                    continue
                size = prefix_size(len(s))
                keys = shared.value.keys(s)
                first = np.argpartition(keys, size - 1)[:size] if size < len(s) else np.arange(len(s))
                first = first[np.lexsort((s[first], keys[first]))]
                found.append((s[first], digest(s), len(s), int(keys[first[-1]])))
            if found:
                sizes = np.array([len(f[0]) for f in found])
                repeated = [np.repeat(np.array([f[k] for f in found], dtype=np.int64), sizes) for k in (1, 2, 3)]
                place = np.concatenate([np.arange(1, k + 1) for k in sizes])
                yield _batch(
                    token=np.concatenate([f[0] for f in found]).view(np.int64), **{"class": repeated[0]},
                    n=repeated[1].astype(np.int32), place=place.astype(np.int32), size=np.repeat(sizes, sizes).astype(np.int32), last=repeated[2],
                )

    return stored(docs.select(text_or_empty().alias("text")).mapInArrow(run, "token bigint, class bigint, n int, place int, size int, last bigint"))


def shared_prefixes(prefix: DataFrame) -> DataFrame:
    """Rows of `prefix` whose token occurs more than once, each class once, with two figures of the
    class: `alone`, how many n-grams of its beginning no other beginning has, and `weight`, how often the
    others occur in all. Stored.
    """
    # Stored, so that the join below shuffles both sides and a hot token can be split.
    twice = stored(prefix.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1"))
    rows = stored(prefix.join(twice, "token").distinct())
    figures = rows.groupBy("class").agg(F.count("*").alias("known"), F.sum("rows").alias("weight"))
    joined = rows.drop("rows").join(figures, "class")
    return stored(joined.withColumn("alone", F.col("size") - F.col("known")).drop("known"))


def _compatible() -> Column:
    """Whether sizes, and what the set whose beginning ends first has alone, leave room for a link.

    What that set has alone would stand in the other's beginning if the other had it. N-grams of the
    beginning that ends last may stand in the other set behind its beginning, so they prove nothing.
    """
    n, other = F.col("n"), F.col("other_n")
    mine = F.when(F.col("last") < F.col("other_last"), n - F.col("alone")).otherwise(n)
    theirs = F.when(F.col("other_last") < F.col("last"), other - F.col("other_alone")).otherwise(other)
    most = F.least(mine, theirs)
    return (F.least(n, other) * 100 >= F.greatest(n, other) * PERCENT) & ((100 + PERCENT) * most >= PERCENT * (n + other))


def _bounded_pairs(met: DataFrame) -> DataFrame:
    """Pairs (class, n, other, other_n, common) that may be linked, from rows of one shared token each.

    Common n-grams beyond both beginnings are at most what is left of either set there.
    """
    pairs = met.groupBy("class", "n", "size", "last", "other", "other_n", "other_size", "other_last").agg(
        F.count("*").alias("common"), F.max("place").alias("place"), F.max("other_place").alias("other_place")
    )
    mine = F.when(F.col("last") < F.col("other_last"), F.col("size")).otherwise(F.col("place"))
    theirs = F.when(F.col("other_last") < F.col("last"), F.col("other_size")).otherwise(F.col("other_place"))
    most = F.col("common") + F.least(F.col("n") - mine, F.col("other_n") - theirs)
    enough = (100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("other_n"))
    return pairs.where(enough).select("class", "n", "other", "other_n", "common")


OTHER = {"class": "other", "n": "other_n", "place": "other_place", "size": "other_size", "last": "other_last", "alone": "other_alone", "group": "other_group"}


def _star_pairs(shared: DataFrame, turn: int) -> DataFrame:
    """For each class the partner of another group that shares most with it, among one for each token.

    `shared` has `group`, what a class is connected with so far. First the partner is the class whose
    n-grams are the most common ones, such as the original of many copies; later it is one by chance.
    """
    columns = [c for c in OTHER if c in shared.columns]
    rank = F.xxhash64(F.lit(turn), "group", "class") if turn else F.col("weight") / F.col("size")
    leader = shared.groupBy("token").agg(F.max_by(F.struct(*columns), F.struct(rank, "class")).alias("leader"))
    leader = leader.select("token", *(F.col(f"leader.{c}").alias(OTHER[c]) for c in columns))
    met = shared.join(leader, "token").where((F.col("group") != F.col("other_group")) & _compatible())
    best = _bounded_pairs(met).groupBy("class", "n").agg(F.max_by(F.struct("other", "other_n"), F.struct("common", "other")).alias("best"))
    return best.select("class", "n", "best.other", "best.other_n")


def _remaining_pairs(shared: DataFrame) -> DataFrame:
    """All pairs of classes of different groups that share a token and may be linked."""
    groups = shared.groupBy("token").agg(F.min("group").alias("least"), F.max("group").alias("most"))
    mixed = shared.join(groups.where("least <> most").select("token"), "token")
    columns = [c for c in OTHER if c in shared.columns]
    other = mixed.select("token", *(F.col(c).alias(OTHER[c]) for c in columns))
    met = mixed.join(other, "token").where((F.col("class") < F.col("other")) & (F.col("group") != F.col("other_group")) & _compatible())
    return _bounded_pairs(met).drop("common")


def _fragments(s: np.ndarray, count: int) -> list[np.ndarray]:
    """The set cut at equal distances of the order of hashes."""
    bounds = [np.uint64(k * ((1 << 64) // count)) for k in range(1, count)]
    return np.split(s, np.searchsorted(s, bounds))


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, *, fragments: int = FRAGMENTS, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(class, other) of those `pairs` whose similarity reaches the threshold, stored.

    One document of each class sends its fragments to where its partners' are; what they share is
    counted fragment by fragment and summed for each pair.
    """
    pairs = stored(pairs)
    sent = pairs.select("class", F.col("other").alias("to")).unionByName(pairs.select(F.col("other").alias("class"), F.col("other").alias("to"))).distinct()
    wanted = sent.groupBy("class").agg(F.collect_list("to").alias("to"))
    holder = classes.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("holder"))
    wanted = stored(wanted.join(holder, "class").select("holder", F.col("class").alias("wanted"), "to"))
    small = bounded(wanted, wanted.agg(F.sum(F.size("to"))).first()[0] or 0, max_broadcast_rows)
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(small, F.col("doc_id").eqNullSafe(F.col("holder"))).select("text", "wanted", "to")

    def run(batches):
        for batch, sets in _texts(batches):
            out: dict[str, list] = {"at": [], "class": [], "fragment": [], "part": []}
            for s, wanted_class, targets in zip(sets, batch["wanted"].to_pylist(), batch["to"].to_pylist(), strict=True):
                if digest(s) != wanted_class:
                    continue  # another text with the same id
                parts = [p.view(np.int64) for p in _fragments(s, fragments)]
                for target in targets:
                    for k, part in enumerate(parts):
                        if len(part):
                            for name, value in zip(out, (target, wanted_class, k, part), strict=True):
                                out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out["at"], pa.int64()), pa.array(out["class"], pa.int64()), pa.array(out["fragment"], pa.int32()), pa.array(out["part"], pa.list_(pa.int64()))], names=list(out))

    parts = texts.mapInArrow(run, "at bigint, class bigint, fragment int, part array<bigint>")
    parts = stored(parts.dropDuplicates(["at", "class", "fragment"]) if _repeated(classes) else parts)
    own = parts.where("at = class").select("at", "fragment", F.col("part").alias("own"))
    counted = parts.where("at <> class").join(own, ["at", "fragment"]).select("class", "at", F.size(F.array_intersect("part", "own")).alias("common"))
    overlap = counted.groupBy("class", F.col("at").alias("other")).agg(F.sum("common").alias("common"))
    enough = (100 + PERCENT) * F.col("common") >= PERCENT * (F.col("n") + F.col("other_n"))
    return stored(pairs.join(overlap, ["class", "other"]).where(enough).select("class", "other"))


def _repeated(classes: DataFrame) -> bool:
    """Whether any id has several rows, so that a class may be sent twice."""
    return not classes.groupBy("doc_id").count().where("count > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(class, group) of every class in `edges` (class, other): group is the least class it is connected with.

    Large and small stars in turn: neighbours move to the least one around. Each turn is stored;
    hubs are aggregated in the tasks before their rows meet.
    """
    edges = stored(edges.select(F.greatest("class", "other").alias("u"), F.least("class", "other").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u")
        edges = stored(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if state == before:
            break
        before = state
    leaves = edges.select(F.col("u").alias("class"), F.col("v").alias("group"))
    return stored(leaves.unionByName(edges.select(F.col("v").alias("class"), F.col("v").alias("group")).distinct()))


def grouped_documents(docs: DataFrame, *, common: int = COMMON, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(doc_id, text_hash, n, group) of every row of `docs`; group is null without n-grams, else the same for all that are connected."""
    classes = document_classes(docs)
    order = Order(common_shingles(docs, common=common))
    shared = shared_prefixes(prefixes(docs, order))
    groups: DataFrame | None = None

    def now() -> DataFrame:
        if groups is None:
            return shared.withColumn("group", F.col("class"))
        return shared.join(groups, "class", "left").withColumn("group", F.coalesce("group", "class"))

    last = False
    for turn in range(max_rounds + 1):
        last = last or turn == max_rounds
        found = linked(docs, classes, _remaining_pairs(now()) if last else _star_pairs(now(), turn))
        if not found.isEmpty():
            known = found if groups is None else found.unionByName(groups.select("class", F.col("group").alias("other")))
            groups = components(known)
        elif not last:
            found = linked(docs, classes, _remaining_pairs(now()))
            if not found.isEmpty():
                groups = components(found if groups is None else found.unionByName(groups.select("class", F.col("group").alias("other"))))
            last = True
        if last:
            break
    own = F.when(F.col("n") > 0, F.col("class"))
    if groups is None:
        return classes.select("doc_id", "text_hash", "n", own.alias("group"))
    joined = classes.join(groups, "class", "left")
    return joined.select("doc_id", "text_hash", "n", F.when(F.col("n") > 0, F.coalesce("group", "class")).alias("group"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs`: the least id its group holds, its own without n-grams."""
    grouped = grouped_documents(docs, **options)
    # Stored for the same reason: a group may hold a third of all rows.
    least = stored(grouped.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id")))
    joined = grouped.join(least, "group", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one row of each group, that of the least id, and all rows without n-grams."""
    grouped = stored(grouped_documents(docs, **options))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = grouped.where("group is not null").groupBy("group").agg(F.min_by(F.struct("doc_id", "text_hash"), order).alias("first"))
    empty = grouped.where("group is null").select("doc_id", "text_hash").distinct()
    kept = stored(first.select("first.*").unionByName(empty).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    small = bounded(kept, kept.count(), MAX_BROADCAST_ROWS)
    rows = docs.join(small, docs["doc_id"].eqNullSafe(small["__id"]) & (F.xxhash64(docs["text"]) == small["__hash"]), "left_semi")
    if not _repeated(grouped):
        return rows
    blank = F.trim(F.translate(text_or_empty(), "\t\n\x0b\f\r", "     ")) == ""
    return rows.where(~blank).dropDuplicates(["doc_id", "text"]).unionByName(rows.where(blank))
