"""Hard negatives of anchors by exact integer inner products, tile by tile with Strassen's recursion.

Rows are dealt over a grid: a group holds some of the anchors and some of all rows, both bounded in
number whatever the labels and however often a vector occurs. In a group the scores of a tile of
anchors and a tile of candidates come from Strassen's recursion on 64-bit integers, padded with
zeros to even sides. Of each group an anchor keeps a heap of its best rows, and the heaps of all
groups are merged. Two rounds: the first finds the anchors' positives (rows of their label), the
second, for each positive, the best rows of other labels with a score in the positive's window.

Components are scaled and rounded down to integers. Rows with a null label, a null vector, or a null
or non-finite component take no part. Rows that agree in id, label and vector are one row; rows
that share an id only are different rows, but never partners of each other. A null id makes no
anchor, and as a candidate comes after all others of its score. Missing components at the end of a
vector count as zero, and so does an empty vector. Ties go to the smaller id. A label without
another row gives its anchors no positives, and a window without rows no negatives. Vectors so long
or large that a score could pass 2**56 are an error. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meteorill.llm.tables import stored

SCALE = 256
KEPT = 5
#: Percent of the positive's score between which a negative's score lies.
LOW, HIGH = 80, 100
#: Anchors and candidates of a group, and of a tile; sides up to LEAF are multiplied directly.
GROUP_ANCHORS, GROUP_ROWS = 1024, 1 << 14
TILE_ANCHORS, TILE_ROWS = 256, 1024
LEAF = 16
MOST = 1 << 56
LAST = np.iinfo(np.int64).max


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices with seven half-sized products at each step."""
    (rows, inner), columns = a.shape, b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    r, i, c = (rows + 1) // 2, (inner + 1) // 2, (columns + 1) // 2
    a11, a12, a21, a22 = a[:r, :i], a[:r, i:], a[r:, :i], a[r:, i:]
    b11, b12, b21, b22 = b[:i, :c], b[:i, c:], b[i:, :c], b[i:, c:]
    both = strassen(a11 + a22, b11 + b22, leaf)
    lower = strassen(a21 + a22, b11, leaf)
    right = strassen(a11, b12 - b22, leaf)
    left = strassen(a22, b21 - b11, leaf)
    upper = strassen(a11 + a12, b22, leaf)
    down = strassen(a21 - a11, b11 + b12, leaf)
    across = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * c), dtype=np.int64)
    out[:r, :c] = both + left - upper + across
    out[:r, c:] = right + upper
    out[r:, :c] = lower + left
    out[r:, c:] = both - lower + right + down
    return out[:rows, :columns]


def scaled(vectors: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """Rows of `width` integers, zeros after the end of a vector."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    out = np.zeros((len(lists), width), dtype=np.int64)
    lengths = np.diff(lists.offsets.to_numpy())
    values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(values) and float(np.abs(values).max()) ** 2 * width >= MOST:
        raise ArithmeticError("scores of these vectors could pass the bound of 2**56")
    out[np.arange(width) < lengths[:, None]] = values.astype(np.int64)
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max(1, *(max(np.diff(c.combine_chunks().offsets.to_numpy()), default=0) for c in columns))


def _ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the last of all in place of null, and which are null."""
    return column.fill_null(LAST).to_numpy(), column.is_null().to_numpy()


class Heaps:
    """The best `size` (score, id) of each of `n` owners; higher scores first, then smaller ids."""

    def __init__(self, n: int, size: int) -> None:
        self.size = size
        self.owner = np.empty(0, dtype=np.int64)
        self.score, self.id, self.null = self.owner, self.owner, np.empty(0, dtype=bool)
        self.least = np.full(n, np.iinfo(np.int64).min)

    def offer(self, owner, score, ids, null) -> None:
        """Merge further rows. They come by id, so that one needs a score above the least of a full heap."""
        both = [np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.id, ids), (self.null, null))]
        order = np.lexsort((both[3], both[2], -both[1], both[0]))
        owners = both[0][order]
        first = np.flatnonzero(np.diff(owners, prepend=-1))
        place = np.arange(len(owners)) - np.repeat(first, np.diff(np.append(first, len(owners))))
        kept = order[place < self.size]
        self.owner, self.score, self.id, self.null = (x[kept] for x in both)
        full = place == self.size - 1
        self.least[owners[full]] = both[1][order][full]


def _tiles(anchors: pa.Table, rows: pa.Table, scale: int):
    """(anchor range, rows by id, scores) of all tiles of a group."""
    width = _width(anchors["vector"], rows["vector"])
    rows = rows.sort_by("vec_id")
    a, b = scaled(anchors["vector"], width, scale), scaled(rows["vector"], width, scale)
    for x in range(0, len(a), TILE_ANCHORS):
        for y in range(0, len(b), TILE_ROWS):
            yield slice(x, x + TILE_ANCHORS), slice(y, y + TILE_ROWS), strassen(a[x : x + TILE_ANCHORS], np.ascontiguousarray(b[y : y + TILE_ROWS].T))


def _positives(anchors: pa.Table, rows: pa.Table, scale: int, kept: int) -> pa.Table:
    rows = rows.sort_by("vec_id")
    ids, null = _ids(rows["vec_id"])
    own, labels, other = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy(), rows["label"].to_numpy()
    heaps = Heaps(anchors.num_rows, kept)
    for x, y, scores in _tiles(anchors, rows, scale):
        same = (labels[x, None] == other[None, y]) & ((own[x, None] != ids[None, y]) | null[None, y])
        r, c = np.nonzero(same & (scores > heaps.least[x, None]))
        heaps.offer(r + x.start, scores[r, c], ids[y][c], null[y][c])
    return pa.table(
        {
            "anchor": pa.array(anchors["anchor"].to_numpy()[heaps.owner]),
            "positive_id": pa.array(heaps.id, mask=heaps.null),
            "positive_score": pa.array(heaps.score),
        }
    )


def _negatives(anchors: pa.Table, rows: pa.Table, scale: int, kept: int, low: int, high: int) -> pa.Table:
    """Anchors come once for each positive, those of one anchor together."""
    rows = rows.sort_by("vec_id")
    anchors = anchors.sort_by([("anchor", "ascending"), ("place", "ascending")])
    ids, null = _ids(rows["vec_id"])
    key = anchors["anchor"].to_numpy()
    first = np.flatnonzero(np.diff(key, prepend=-1))
    single = anchors.take(pa.array(first))
    own, labels, other = single["vec_id"].to_numpy(), single["label"].to_numpy(), rows["label"].to_numpy()
    wanted = anchors["positive_score"].to_numpy()
    least, most = -((-low * wanted) // 100), (high * wanted) // 100
    bounds = np.append(first, len(key))
    heaps = Heaps(len(key), kept)
    for x, y, scores in _tiles(single, rows, scale):
        apart = (labels[x, None] != other[None, y]) & ((own[x, None] != ids[None, y]) | null[None, y])
        for place in range(int(np.diff(bounds).max(initial=0))):
            # The positive at this place of each anchor that has one.
            has = np.flatnonzero(bounds[x.start : x.start + len(scores)] + place < bounds[x.start + 1 : x.start + 1 + len(scores)])
            at = bounds[x.start + has] + place
            inside = scores[has]
            r, c = np.nonzero(apart[has] & (inside >= least[at, None]) & (inside > heaps.least[at, None]) & (inside <= most[at, None]))
            heaps.offer(at[r], inside[r, c], ids[y][c], null[y][c])
    picked = anchors.take(pa.array(heaps.owner)).select(["anchor", "vec_id", "place", "positive_id", "positive_score"])
    picked = picked.append_column("negative_id", pa.array(heaps.id, mask=heaps.null))
    return picked.append_column("negative_score", pa.array(heaps.score))


def _numbers(n: int) -> Column:
    """A row for each number below `n`."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, repeated ones once."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    taken = rows.where(F.col("label").isNotNull() & F.col(vector).isNotNull() & finite)
    return taken.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector")).distinct()


def mine(rows: DataFrame, anchor: Column, *, vector: str = "embedding", scale: int = SCALE, kept: int = KEPT, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each
    of its first `kept` positives the first `kept` rows of another label in the positive's window.

    `anchor` says of (vec_id, label, vector) which rows are anchors. Ranks count from 1.
    """
    everything = stored(usable(rows, vector))
    anchors = stored(everything.where(anchor & F.col("vec_id").isNotNull()).withColumn("anchor", F.monotonically_increasing_id()))
    strips, shares = max(1, math.ceil(anchors.count() / GROUP_ANCHORS)), max(1, math.ceil(everything.count() / GROUP_ROWS))
    # Every group of the grid meets a strip of the anchors with a share of the rows.
    dealt = everything.select("*", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shares)).alias("share")).withColumn("strip", _numbers(strips))

    def met(some: DataFrame, function, schema: str) -> DataFrame:
        spread = some.withColumn("strip", F.pmod(F.xxhash64("anchor"), F.lit(strips))).withColumn("share", _numbers(shares))
        grid = ["strip", "share"]
        return spread.groupBy(*grid).cogroup(dealt.groupBy(*grid)).applyInArrow(function, schema)

    def best(df: DataFrame, keys: list[str], score: str, by: str, rank: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(by))
        return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= kept)

    first = met(anchors, lambda a, b: _positives(a, b, scale, kept), "anchor bigint, positive_id bigint, positive_score bigint")
    positives = stored(best(first, ["anchor"], "positive_score", "positive_id", "place").join(anchors, "anchor"))
    second = met(
        positives,
        lambda a, b: _negatives(a, b, scale, kept, low, high),
        "anchor bigint, vec_id bigint, place int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    ranked = best(second, ["anchor", "place"], "negative_score", "negative_id", "rank")
    return ranked.select(F.col("vec_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
