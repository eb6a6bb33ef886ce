"""Moving documents from old shards to new ones with the fewest bytes moved.

Documents of an old shard are dealt by hash into a fixed number of blocks. A minimum-cost flow from
the old shards' sizes to the new capacities says how many bytes go from which shard to which; blocks
are then picked to make up those flows. Only shard and block sizes, whose number is fixed, reach the
driver; documents are joined to their block's place, numbered within blocks, and written.

A null text counts no bytes. Null ids, repeated rows and equal texts are rows like any other; equal
rows share a block and are numbered apart. An empty table has an empty plan. A clashing column of
the documents is not lost: what this adds is named `shard`, `slot` and `moved`, and a document's own
columns of these names are left out of what is written.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meteorill.llm.tables import text_or_empty
from meteorill.plans.workspace import new_folder

#: Bytes that a document takes besides its text.
OVERHEAD = 16
BLOCKS = 512
#: A new shard is written by so many tasks at least, and by more if each would get more than so many bytes.
PARTS, TASK_BYTES = 4, 256 << 20


def document_size(text: str = "text") -> Column:
    return F.octet_length(text_or_empty(text)).cast("long") + OVERHEAD


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """What each (source, sink) carries when all of `supply` is sent at the least `cost(source, sink)` a unit.

    Successive shortest paths with potentials over the bipartite graph; sums must be equal.
    """
    if sum(supply) != sum(capacity):
        raise ValueError("capacities must add up to what there is")
    n, m = len(supply), len(capacity)
    price = [[cost(i, j) for j in range(m)] for i in range(n)]
    flow: dict[tuple[int, int], int] = {}
    carried: list[set[int]] = [set() for _ in range(m)]  # sources of each sink's flow
    left, room = list(supply), list(capacity)
    # Costs are not negative, so zero potentials are feasible.
    potential = [0] * (n + m)
    while any(left):
        # Dijkstra from all sources that have something left; sinks are nodes n...
        distance, came = [float("inf")] * (n + m), [-1] * (n + m)
        heap = []
        for i in range(n):
            if left[i]:
                distance[i] = 0
                heap.append((0, i))
        final = [False] * (n + m)
        while heap:
            d, v = heapq.heappop(heap)
            if final[v]:
                continue
            final[v] = True
            if v < n:
                edges = ((n + j, price[v][j]) for j in range(m))
            else:
                edges = ((i, -price[i][v - n]) for i in carried[v - n])
            for w, c in edges:
                if not final[w] and (new := d + c + potential[v] - potential[w]) < distance[w]:
                    distance[w], came[w] = new, v
                    heapq.heappush(heap, (new, w))
        open_sinks = [n + j for j in range(m) if room[j]]
        end = min(open_sinks, key=lambda v: distance[v] + potential[v])
        reach = distance[end]
        for v in range(n + m):
            potential[v] += min(distance[v], reach)
        path = [end]
        while came[path[-1]] >= 0:
            path.append(came[path[-1]])
        path.reverse()
        amount = min(left[path[0]], room[end - n])
        for v, w in zip(path, path[1:], strict=False):
            if v >= n:
                amount = min(amount, flow[w, v - n])
        for v, w in zip(path, path[1:], strict=False):
            if v < n:
                flow[v, w - n] = flow.get((v, w - n), 0) + amount
                carried[w - n].add(v)
            else:
                flow[w, v - n] -= amount
                if not flow[w, v - n]:
                    del flow[w, v - n]
                    carried[v - n].discard(w)
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


@dataclass(frozen=True)
class Block:
    old: int
    block: int
    size: int
    rows: int


@dataclass(frozen=True)
class Plan:
    """`places`: the new shard of each (old shard, block); `flow`: bytes by (old, new) as solved."""

    new_shards: int
    places: dict[Block, int]
    flow: dict[tuple[int, int], int]

    def sizes(self) -> list[int]:
        total = [0] * self.new_shards
        for block, shard in self.places.items():
            total[shard] += block.size
        return total

    def affected(self) -> set[int]:
        """Shards whose files have to be written: something comes or goes."""
        moves = [(b.old, s) for b, s in self.places.items() if b.old != s]
        return {s for move in moves for s in move if s < self.new_shards}

    def moved_bytes(self) -> int:
        return sum(b.size for b, s in self.places.items() if b.old != s)


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def make_plan(blocks: list[Block], capacity: list[int], *, cost=lambda old, new: int(old != new)) -> Plan:
    """Blocks for the flows: the largest first, each to where most of its shard's flow is still missing;
    then single blocks change places while that evens out the fullest and the emptiest shard.
    """
    olds = sorted({b.old for b in blocks})
    supply = [sum(b.size for b in blocks if b.old == old) for old in olds]
    flow = {(olds[i], j): amount for (i, j), amount in min_cost_flow(supply, capacity, lambda i, j: cost(olds[i], j)).items()}
    places: dict[Block, int] = {}
    for old in olds:
        missing = {j: amount for (i, j), amount in flow.items() if i == old}
        for block in sorted((b for b in blocks if b.old == old), key=lambda b: (-b.size, b.block)):
            shard = max(missing, key=lambda j: (missing[j], j == old, -j))
            missing[shard] -= block.size
            places[block] = shard
    plan = Plan(len(capacity), places, flow)
    over = [size - room for size, room in zip(plan.sizes(), capacity, strict=True)]
    while blocks:
        high, low = max(range(len(over)), key=over.__getitem__), min(range(len(over)), key=over.__getitem__)
        gap = over[high] - over[low]
        fitting = [b for b, s in places.items() if s == high and b.size < gap]
        if not fitting:
            break
        block = min(fitting, key=lambda b: (abs(2 * b.size - gap), b.old == high, b.old, b.block))
        if min(block.size, gap - block.size) < max(1, gap // 16):
            break
        places[block] = low
        over[high] -= block.size
        over[low] += block.size
    return plan


def _keyed(docs: DataFrame, old_shard: Column, blocks: int) -> DataFrame:
    key = F.pmod(F.xxhash64(F.lit("block"), F.col("doc_id"), F.col("text")), F.lit(blocks)).cast("int")
    return docs.select("*", old_shard.cast("int").alias("__old"), key.alias("__block"))


def plan_resharding(docs: DataFrame, old_shard: Column, new_shards: int, *, blocks: int = BLOCKS) -> Plan:
    """The plan for shards of equal bytes. Sizes are summed in the tasks; old shards times blocks come here."""
    sizes = _keyed(docs.select("doc_id", "text"), old_shard, blocks).groupBy("__old", "__block").agg(F.sum(document_size()).alias("size"), F.count("*").alias("rows"))
    found = [Block(r["__old"], r["__block"], r["size"], r["rows"]) for r in sizes.collect()]
    return make_plan(sorted(found, key=lambda b: (b.old, b.block)), equal_capacities(sum(b.size for b in found), new_shards))


def place(docs: DataFrame, old_shard: Column, plan: Plan, *, blocks: int = BLOCKS, parts: int = PARTS) -> DataFrame:
    """`docs` with shard, slot (gapless from 0 in each shard) and moved, dealt to tasks by parts of shards."""
    rows, filled = [], [0] * plan.new_shards
    parts = max(parts, -(-max(plan.sizes(), default=0) // TASK_BYTES))
    for number, (block, shard) in enumerate(sorted(plan.places.items(), key=lambda x: (x[0].old, x[0].block))):
        rows.append((block.old, block.block, shard, number % parts, filled[shard]))
        filled[shard] += block.rows
    spark = docs.sparkSession
    where = spark.createDataFrame(rows, "__old int, __block int, __shard int, __part int, __first bigint")
    own = [c for c in docs.columns if c not in ("shard", "slot", "moved")]
    keyed = _keyed(docs.select(*own), old_shard, blocks).join(F.broadcast(where), ["__old", "__block"])
    order = Window.partitionBy("__shard", "__part", "__old", "__block").orderBy("doc_id", F.xxhash64("text"))
    dealt = keyed.repartition("__shard", "__part").withColumn("__row", F.row_number().over(order))
    return dealt.select(*own, F.col("__shard").alias("shard"), (F.col("__first") + F.col("__row") - 1).alias("slot"), (F.col("__old") != F.col("__shard")).alias("moved"))


def rewrite(docs: DataFrame, old_shard: Column, plan: Plan, *, blocks: int = BLOCKS) -> DataFrame:
    """Write the files of all shards that the plan changes, in a folder for each, and return every row
    with shard, slot and moved: read from the new files, and from `docs` for untouched shards.
    """
    spark, path, affected = docs.sparkSession, new_folder(docs.sparkSession), sorted(plan.affected())
    placed = place(docs, old_shard, plan, blocks=blocks)
    if not affected:
        return placed
    changed = placed.where(F.col("shard").isin(affected))
    changed.write.partitionBy("shard").parquet(path)
    written = spark.read.schema(placed.schema).parquet(path).select(*placed.columns)
    return written if len(affected) == plan.new_shards else written.unionByName(placed.where(~F.col("shard").isin(affected)))
