"""Removal of repeated byte strings across documents, exact to the byte, with suffix arrays.

Every string of `length` bytes is removed where it also starts earlier. Strings meet by an anchor:
among the k-grams in a string the one with the least hash, which is the same wherever the string
stands. Strings that follow each other and share their anchor are a run, one row for some forty
bytes of text. Only runs whose anchor occurs elsewhere go on. Equal runs are settled by the first of
them. What is left are different runs around one anchor: their texts are put together in bounded
portions, and the suffixes of each portion are sorted in two stages - those smaller than their
successor directly, the others induced from them by scans of the buckets. Neighbours in that order
with a common prefix of `length` bytes are the same string.

Where more than `together` different runs surround one anchor, they are split by what stands there. The strings
of a run are told apart by how far in them the anchor stands; those of one half of these distances
all contain the same longer piece of text around the anchor, and equal strings have the same one. So each half of
a run goes to the runs with the same piece, again settled where equal, sorted where few enough, or split: after
seven halvings a string is its own piece. A run makes at most one row for each half, and most halves are alone
with their piece and end there.

A null text is empty. Texts shorter than `length`, among them those of few letters, lose nothing; very long ones are read in
stretches of `STRETCH` bytes. Rows with equal ids but different texts are different documents, ordered by a
checksum of the text; fully equal rows are one document, and all lose the same. Null ids are smaller than all others.
Of equal strings in one document the one that starts first stays. An empty table gives an empty result. Further columns, whatever
their names, play no part. Runs, strings and texts are taken as equal if their hashes are: 128 bits of anchor and content, 64 of
the text besides the id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.jaccard_join import _mixed, _powers
from meteorill.llm.tables import stored, text_or_empty

LENGTH = 100
K = 24
#: String starts handled at a time, and bytes of runs that are sorted together.
STRETCH, PORTION = 1 << 20, 1 << 19
#: Different runs around one anchor that one task compares directly; beyond, they are split.
TOGETHER = 512
MAX_BROADCAST_ROWS = 500_000

#: A run in a document as one number: 32 bits of the start, 8 of how many strings, 8 of the anchor's distance in the first.
COUNT_BITS, ANCHOR_BITS = 8, 8
PLACE = "doc_id {0}, text_hash bigint, start bigint, count int"


def packed(start: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << (COUNT_BITS + ANCHOR_BITS)) | (count.astype(np.int64) << ANCHOR_BITS) | anchor.astype(np.int64)


def unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> (COUNT_BITS + ANCHOR_BITS), (at >> ANCHOR_BITS) & ((1 << COUNT_BITS) - 1), at & ((1 << ANCHOR_BITS) - 1)


def _least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def _anchored(data: bytes, length: int, k: int) -> Iterator[tuple]:
    """(begin, running hash, inverse powers, k-gram hashes, firsts, lasts, anchors) of the runs in each portion of `data`."""
    whole = np.frombuffer(data, dtype=np.uint8)
    low = np.uint64((1 << 24) - 1)
    for begin in range(0, len(whole) - length + 1, STRETCH):
        part = whole[begin : begin + STRETCH + length - 1]
        up, down, table = _powers(max(16, len(part).bit_length()))
        with np.errstate(over="ignore"):
            running = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(table[part] * up[: len(part)], out=running[1:])
            grams = _mixed((running[k:] - running[:-k]) * down[: len(part) - k + 1])
            least = _least_in_windows((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - k + 1) & low
        first = np.flatnonzero(np.diff(least, prepend=np.uint64(1 << 30)))
        last = np.append(first[1:], len(least)) - 1
        yield begin, running, down, grams, first, last, least[first].astype(np.int64)


def runs(data: bytes, length: int = LENGTH, k: int = K) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, content hash, start, number of strings, distance of the anchor) of the runs in `data`, in portions."""
    for begin, running, down, grams, first, last, anchor in _anchored(data, length, k):
        with np.errstate(over="ignore"):
            content = (running[last + length] - running[first]) * down[first]
            content = _mixed(content + ((anchor - first) * 256 + (last - first)).astype(np.uint64))
        yield grams[anchor], content, begin + first, last - first + 1, anchor - first


def anchor_rows(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(anchor) of all runs of all documents: `run_rows` without what a count of anchors has no use for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = []
            size = 0
            for row, text in enumerate(batch["text"]):
                for _, _, _, grams, _, _, anchor in _anchored(text.as_py(), length, k):
                    found.append(grams[anchor])
                    size += len(anchor)
                if size > 100_000 or (row + 1 == batch.num_rows and size):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["anchor"])
                    found, size = [], 0

    return docs.select(text_or_empty().cast("binary").alias("text")).mapInArrow(run, "anchor bigint")


def run_rows(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(anchor, content, doc_id, text_hash, at) of all runs of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = [[], [], [], []]
            owners, texts, size = batch["doc_id"], batch["text_hash"], 0
            for row, text in enumerate(batch["text"]):
                for anchor, content, start, count, distance in runs(text.as_py(), length, k):
                    for column, values in zip(found, (anchor.view(np.int64), content.view(np.int64), np.full(len(start), row), packed(start, count, distance)), strict=True):
                        column.append(values)
                    size += len(start)
                if size > 100_000 or (row + 1 == batch.num_rows and size):
                    a, c, r, at = (np.concatenate(x) for x in found)
                    r = pa.array(r)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c), owners.take(r), texts.take(r), pa.array(at)], names=["anchor", "content", "doc_id", "text_hash", "at"])
                    found, size = [[], [], [], []], 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _bytes_of(docs).mapInArrow(run, f"anchor bigint, content bigint, doc_id {kind}, text_hash bigint, at bigint")


def _bytes_of(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of `data` (bytes) in the order of their first `depth` bytes at least.

    Suffixes smaller than their successors are sorted directly, by their first bytes. Then the
    buckets of first bytes are scanned in ascending order: a suffix larger than its successor comes
    before the others of its bucket, in the order of the successors.
    """
    size = len(data)
    if not size:
        return np.empty(0, dtype=np.int64)
    following = np.append(data[1:], 0).astype(np.int16)
    following[-1] = -1
    step = np.sign(following - data)  # 1: smaller than the successor, -1: larger, 0: as the successor
    change = np.flatnonzero(step)
    smaller = step[change[np.searchsorted(change, np.arange(size))]] > 0
    direct = np.flatnonzero(smaller)
    direct = direct[np.argsort(beginnings(data, direct, depth).view(f"S{depth}").ravel(), kind="stable")]

    counts = np.bincount(data, minlength=256)
    heads = np.concatenate([[0], np.cumsum(counts)])
    order, rank = np.empty(size, dtype=np.int64), np.full(size + 1, -1, dtype=np.int64)
    at_end = heads[1:][data[direct]] - np.bincount(data[direct], minlength=256)[data[direct]]
    first_of = np.concatenate([[0], np.cumsum(np.bincount(data[direct], minlength=256))])[data[direct]]
    places = at_end + np.arange(len(direct)) - first_of
    order[places] = direct
    rank[direct] = places
    larger = np.flatnonzero(~smaller)
    by_byte = larger[np.argsort(data[larger], kind="stable")]
    limits = np.concatenate([[0], np.cumsum(np.bincount(data[larger], minlength=256))])
    for byte in np.flatnonzero(np.diff(limits)):
        own = by_byte[limits[byte] : limits[byte + 1]]
        fresh = own[following[own] < byte]
        fresh = fresh[np.argsort(rank[fresh + 1], kind="stable")]
        head = heads[byte]
        while len(fresh):
            order[head : head + len(fresh)] = fresh
            rank[fresh] = np.arange(head, head + len(fresh))
            head += len(fresh)
            before = fresh[fresh > 0] - 1
            fresh = before[(data[before] == byte) & ~smaller[before]]
    return order


def beginnings(data: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """A row of `depth` bytes from each place on, with zeros after the end."""
    padded = np.concatenate([data, np.zeros(depth, dtype=np.uint8)])
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, depth)[places])


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int, block: int = 1 << 14) -> np.ndarray:
    """Bytes that each suffix of `order` has in common with the one before it, up to `depth`; 0 for the first."""
    common = np.zeros(len(order), dtype=np.int64)
    for begin in range(1, len(order), block):
        rows = beginnings(data, order[begin - 1 : begin + block], depth)
        different = rows[1:] != rows[:-1]
        common[begin : begin + block] = np.where(different.any(axis=1), different.argmax(axis=1), depth)
    return common


def equal_strings(segments: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, segment, offset) of every string of `length` bytes inside a segment; equal strings share a cluster."""
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    data = np.frombuffer(b"\0".join([*segments, b""]), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    order = suffix_order(data, length)
    segment = np.searchsorted(starts, order, "right") - 1
    offset = order - starts[segment]
    inside = offset + length <= sizes[segment]
    order, segment, offset = order[inside], segment[inside], offset[inside]
    common = common_prefixes(data, order, length)
    return np.cumsum(common < length), segment, offset


def _settle(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Places of strings that also stand earlier, for one portion of (doc_id, text_hash, start, segment); neighbouring
    strings of a segment go together.
    """
    cluster, segment, offset = equal_strings([r[3] for r in rows], length)
    names = [(r[0] is not None, r[0] if r[0] is not None else 0, r[1]) for r in rows]
    number = {name: k for k, name in enumerate(sorted(set(names)))}
    rank = np.array([number[name] for name in names], dtype=np.int64)
    starts = np.array([r[2] for r in rows], dtype=np.int64)
    begins = counts = later = np.empty(0, dtype=np.int64)
    if len(cluster):
        # A string that two segments hold is one place.
        place = (rank[segment] << 32) | (starts[segment] + offset)
        head = np.flatnonzero(np.diff(cluster, prepend=cluster[0] - 1))
        first = np.repeat(np.minimum.reduceat(place, head), np.diff(np.append(head, len(cluster))))
        later = np.flatnonzero(place > first)
        later = later[np.lexsort((offset[later], segment[later]))]
        apart = (np.diff(segment[later], prepend=-1) != 0) | (np.diff(offset[later], prepend=-2) != 1)
        begins = np.flatnonzero(apart)
        counts = np.diff(np.append(begins, len(later)))
        later = later[begins]
    owner = segment[later].tolist() if len(later) else []
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[s][0] for s in owner]),
            pa.array([rows[s][1] for s in owner], pa.int64()),
            pa.array(starts[owner] + offset[later] if owner else [], pa.int64()),
            pa.array(counts.astype(np.int32)),
        ],
        names=["doc_id", "text_hash", "start", "count"],
    )


def _segments(docs: DataFrame, open_runs: DataFrame, length: int, max_broadcast_rows: int) -> DataFrame:
    """(part, lo, hi, doc_id, text_hash, start, anchor, segment): the texts of runs. `part` says which runs may have equal
    strings, here those around one anchor; lo to hi are the distances of the anchor that these strings may have.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = stored(
        open_runs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("part", "at")).alias("wanted")).withColumnsRenamed({"doc_id": "wanted_id", "text_hash": "wanted_hash"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash"))
    texts = _bytes_of(docs)
    if wanted.count() <= max_broadcast_rows:
        # The texts with such runs are few: only these are shuffled.
        texts = texts.join(F.broadcast(wanted.select("wanted_id", "wanted_hash")), same, "left_semi")
    texts = texts.join(wanted.hint("merge"), same).select("doc_id", "text_hash", "text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, own = batch["text"][row].as_py(), batch["wanted"][row].as_py()
                starts, counts, anchors = unpacked(np.array([w["at"] for w in own], dtype=np.int64))
                cuts = [data[s : s + n + length - 1] for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]
                at = pa.array([row] * len(own), pa.int32())
                zero, last = np.zeros(len(own), dtype=np.int32), np.full(len(own), (1 << ANCHOR_BITS) - 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["part"] for w in own], pa.int64()), pa.array(zero), pa.array(last), batch["doc_id"].take(at), batch["text_hash"].take(at), pa.array(starts), pa.array(anchors.astype(np.int32)), pa.array(cuts, pa.binary())],
                    names=_names(SEGMENT),
                )

    return texts.mapInArrow(cut, SEGMENT.format(kind))


SEGMENT = "part bigint, lo int, hi int, doc_id {0}, text_hash bigint, start bigint, anchor int, segment binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _hash(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"\0".join(parts), digest_size=8).digest(), "big", signed=True)


def halves(part: int, lo: int, hi: int, start: int, anchor: int, segment: bytes, length: int, k: int) -> Iterator[tuple]:
    """(part, lo, hi, start, anchor, segment, content) of those two halves of a run that have strings."""
    hi = min(hi, length - k)
    middle = (lo + hi) // 2
    count = len(segment) - length + 1
    for low, high in ((lo, middle), (middle + 1, hi)):
        # Strings with the anchor `low` to `high` bytes in them, as far as this run has them.
        first, last = max(anchor - high, 0), min(anchor - low, count - 1)
        if low > high or first > last:
            continue
        piece = segment[anchor - low : anchor - high + length]
        own = segment[first : last + length]
        name = f"{part} {low} {high}".encode()
        yield _hash(name, piece), low, high, start + first, anchor - first, own, _hash(f"{anchor - first}".encode(), own)


def _split(segments: DataFrame, length: int, k: int) -> DataFrame:
    """The halves of runs, each with a hash of its content."""
    kind = segments.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = zip(*(batch[c].to_pylist() for c in ("part", "lo", "hi", "start", "anchor", "segment")), strict=True), []
            owner = []
            for number, row in enumerate(rows):
                for half in halves(*row, length, k):
                    out.append(half)
                    owner.append(number)
            at = pa.array(owner, pa.int32())
            part, lo, hi, start, anchor, own, content = zip(*out, strict=True) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), batch["doc_id"].take(at), batch["text_hash"].take(at), pa.array(start, pa.int64()), pa.array(anchor, pa.int32()), pa.array(own, pa.binary()), pa.array(content, pa.int64())],
                names=[*_names(SEGMENT), "content"],
            )

    return segments.mapInArrow(run, SEGMENT.format(kind) + ", content bigint")


def _sorted(segments: DataFrame, length: int) -> DataFrame:
    """Places of strings that stand earlier in the same part; portions of whole parts are sorted together."""
    kind = segments.schema["doc_id"].dataType.simpleString()

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last, doc_type = 0, None, None

        def settled() -> pa.RecordBatch:
            found = _settle(rows, length)
            return pa.RecordBatch.from_arrays([found.column(0).cast(doc_type), *found.columns[1:]], names=found.schema.names)

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for part, *row in zip(*(batch[n].to_pylist() for n in ("part", "doc_id", "text_hash", "start", "segment")), strict=True):
                if size >= PORTION and part != last:
                    yield settled()
                    rows, size = [], 0
                last = part
                rows.append(tuple(row))
                size += len(row[-1])
        if rows:
            yield settled()

    dealt = segments.select("part", "doc_id", "text_hash", "start", "segment").repartition("part").sortWithinPartitions("part", "doc_id", "text_hash", "start")
    return dealt.mapInArrow(sort, PLACE.format(kind))


def repeated_places(docs: DataFrame, *, length: int = LENGTH, k: int = K, together: int = TOGETHER, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_hash, start, count) of strings, `count` at a time, that also start earlier; stored."""
    if not 0 < length - k + 1 < 1 << COUNT_BITS:
        raise ValueError(f"a run of strings of {length} bytes around {k} does not fit {COUNT_BITS} bits")
    everything = run_rows(docs, length, k)
    # Stored, so that the join below shuffles both sides and a hot anchor can be split.
    twice = stored(anchor_rows(docs, length, k).groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1").select("anchor"))
    met = stored(everything.join(twice.hint("shuffle_hash"), "anchor"))
    place = ["doc_id", "text_hash", "at"]
    first = stored(met.groupBy("anchor", "content").agg(F.min(F.struct(*place)).alias("first"), F.count("*").alias("rows")))

    repeats = first.where("rows > 1").select("anchor", "content", *[F.col(f"first.{c}").alias(f"first_{c}") for c in place])
    same = F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("text_hash") == F.col("first_text_hash")) & (F.col("at") == F.col("first_at"))
    count = F.shiftright("at", ANCHOR_BITS).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int").alias("count")
    whole = met.join(repeats.hint("shuffle_hash"), ["anchor", "content"]).where(~same)
    places = [whole.select("doc_id", "text_hash", F.shiftright("at", COUNT_BITS + ANCHOR_BITS).alias("start"), count)]

    mixed = first.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1").withColumnRenamed("anchor", "part")
    open_runs = first.select(F.col("anchor").alias("part"), *[f"first.{c}" for c in place]).join(mixed.select("part"), "part")
    segments = stored(_segments(docs, open_runs, length, max_broadcast_rows))
    sizes = mixed
    for _ in range((length - k + 1).bit_length() + 1):
        known = stored(sizes)
        large = known.where(F.col("contents") > together).select("part")
        places.append(stored(_sorted(segments.join(known.where(F.col("contents") <= together).select("part"), "part"), length)))
        if large.isEmpty():
            break
        half = stored(_split(segments.join(large, "part"), length, k))
        # Equal halves are settled by the first of them, which alone goes on.
        row = F.struct("doc_id", "text_hash", "start", "anchor", "lo", "hi", "segment")
        kept = stored(half.groupBy("part", "content").agg(F.min(row).alias("first"), F.count("*").alias("rows")))
        of = kept.where("rows > 1").select("part", "content", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("doc_id", "text_hash", "start")])
        same = F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("text_hash") == F.col("first_text_hash")) & (F.col("start") == F.col("first_start"))
        strings = (F.octet_length("segment") - (length - 1)).cast("int").alias("count")
        places.append(half.join(of.hint("shuffle_hash"), ["part", "content"]).where(~same).select("doc_id", "text_hash", "start", strings))
        segments = kept.select("part", "first.*")
        sizes = segments.groupBy("part").agg(F.count("*").alias("contents")).where("contents > 1")
    out = places[0]
    for more in places[1:]:
        out = out.unionByName(more)
    return stored(out)


def _remove(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "spans": []}
        for text, places in zip(batch["text"], batch["places"], strict=True):
            data, own = text.as_py(), places.as_py() or []
            starts, counts = (np.array([p[c] for p in own], dtype=np.int64) for c in ("start", "count"))
            delta = np.zeros(len(data) + 1, dtype=np.int64)
            np.add.at(delta, starts, 1)
            np.add.at(delta, starts + counts + length - 1, -1)
            gone = np.cumsum(delta[:-1]) > 0
            edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(len(edges))
            out["kept"].append(np.frombuffer(data, dtype=np.uint8)[~gone].tobytes())
            out["spans"].append(edges.tolist())
        arrays = [batch["doc_id"], *(pa.array(out[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")), pa.array(out["kept"], pa.binary()), pa.array(out["spans"], pa.list_(pa.list_(pa.int64())))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *out])


def deduplicate(
    docs: DataFrame, *, length: int = LENGTH, k: int = K, together: int = TOGETHER, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, spans) of every row of `docs`.

    kept are the remaining bytes, which may begin or end inside a character; spans the maximal
    removed stretches. Only texts that lose something are shuffled, if those have been
    counted to be few enough to be known to all tasks; else all texts are.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    places = repeated_places(docs, length=length, k=k, together=together, max_broadcast_rows=max_broadcast_rows)
    lists = stored(
        places.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "count")).alias("places")).withColumnsRenamed({"doc_id": "list_id", "text_hash": "list_hash"})
    )
    texts = _bytes_of(docs)
    same: Column = F.col("doc_id").eqNullSafe(F.col("list_id")) & (F.col("text_hash") == F.col("list_hash"))
    untouched = None
    if lists.count() <= max_broadcast_rows:
        ids = F.broadcast(lists.select("list_id", "list_hash"))
        untouched = texts.join(ids, same, "left_anti")
        texts = texts.join(ids, same, "left_semi")
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, spans array<array<bigint>>"
    removed = texts.join(lists.hint("merge"), same, "left").select("doc_id", "text", "places").mapInArrow(lambda b: _remove(b, length), schema)
    if untouched is None:
        return removed
    zero = F.lit(0).cast("long")
    nothing = F.array().cast("array<array<bigint>>")
    whole = untouched.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").alias("kept"), nothing.alias("spans"))
    return removed.unionByName(whole)
