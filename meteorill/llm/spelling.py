"""Spelling variants: words that differ by one letter, found level by level in a trie kept as a table.

The words, and the words read backwards, form two tries. A trie is a table of edges between nodes:
the ends of words, beginnings after which words differ, and the places where searches start; an edge
carries the letters between two nodes. A search is a state (word, position, node, edits). It starts
without an edit at the node of the first half of its word: two words that are one edit apart agree in
the first half or, read backwards, in the last. Level by level, by depth of the node, the
states are joined with the edges: an edge that goes on with the word's own letters keeps the edits,
any other takes one edit, a letter replaced by a later one or put in, and a state with an edit follows the word's
letters only. States that reach the end of a word with one edit are neighbours, both ways: a letter left out, or replaced by an
earlier one, is found from the other word. Each edge says how many letters words go on below it and has a
signature of these endings, so that a state without an end dies at once. Nodes are named by hashes; pairs
are compared letter by letter in the end, so that equal hashes of different beginnings do no harm.

A level costs one join, and there are as many as depths at which nodes lie, not as letters in the longest
word. Every edge is shuffled once. Nothing is gathered by word or node: of a node there are at most as
many edges as letters, and states of a node that many words pass are split.

Words are runs of letters A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased. Null and empty texts
have none; a document that occurs twice counts twice; an id may be null. A word of any length is a
word; texts are read in stretches cut between words. Ties between neighbours of equal counts go to the first
in the order of code points. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.jaccard_join import _mixed, _powers
from meteorill.llm.tables import stored, text_or_empty
from meteorill.plans.workspace import new_folder

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A word's form has at least this many times its occurrences.
FACTOR = 10
#: Characters of a text, and distinct words, that a task handles at a time.
STRETCH, HELD = 1 << 20, 200_000
STATE = "side int, word string, q int, pos int, key bigint, edited boolean, near string, `from` int, depth int"
#: Parts of an edge's signature.
SIGNATURE = ["ends0", "ends1", "ends2", "ends3"]
#: In place of a depth: the state has found a neighbour.
FOUND = -1


def word_counts(
    docs: DataFrame, *, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, change: Callable[[object], Callable[[bytes], bytes]] | None = None
) -> DataFrame:
    """(word, n) of the words of all texts with at least so many letters and occurrences.

    `change(doc_id)` gives, for a document, a function of a word to the word to count in its place, both in Latin-1; it may
    leave letters out, but not add any, and may not depend on anything else.
    """
    long_runs, gap = re.compile(f"[{LETTERS}]{{{least_length},}}"), re.compile(f"[^{LETTERS}]")

    def counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in counts], pa.string()), "n": pa.array(counts.values(), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text, begin, own = text.as_py(), 0, Counter()
                while begin < len(text):
                    cut = gap.search(text, begin + STRETCH)
                    end = cut.start() if cut else len(text)
                    own.update(long_runs.findall(text, begin, end))
                    begin = end
                changed = change(doc_id) if change else None
                for found, n in own.items():
                    word = found.encode("latin-1").lower()
                    if changed:
                        word = changed(word)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > HELD:
                    yield counted(counts)
                    counts = Counter()
        yield counted(counts)

    partial = docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _places(words: DataFrame, schema: str) -> DataFrame:
    """For both directions, a row for every place of a word from its half on: the hash of what stands before
    (key), the next letter (0 at the end), and whether searches for the word start there.
    """
    wanted = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [w.encode("latin-1") for w in batch["word"].to_pylist()]
            lengths = np.array([len(t) for t in texts], dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
            for side in (0, 1):
                # Here searches for a word one letter shorter start.
                first = np.maximum(lengths - 1 + side, 0) // 2
                counts = lengths - first + 1
                owner = np.repeat(np.arange(len(texts)), counts)
                depth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + first[owner]
                data = np.frombuffer(b"".join(t[::-1] if side else t for t in texts) + b"\0", dtype=np.uint8)
                up, down, table = _powers(max(16, len(data).bit_length()))
                with np.errstate(over="ignore"):
                    running = np.zeros(len(data) + 1, dtype=np.uint64)
                    np.cumsum(table[data] * up[: len(data)], out=running[1:])
                    begin = starts[owner]
                    key = _mixed((running[begin + depth] - running[begin]) * down[begin] + (2 * depth + side).astype(np.uint64))
                columns = {
                    "side": pa.array(np.full(len(owner), side, dtype=np.int32)),
                    "word": batch["word"].take(pa.array(owner)) if "word" in wanted else None,
                    "depth": pa.array(depth.astype(np.int32)),
                    "key": pa.array(key.view(np.int64)),
                    "next": pa.array(np.where(depth < lengths[owner], data[begin + depth], 0).astype(np.int32)),
                    "start": pa.array(depth == (lengths[owner] + side) // 2),
                }
                yield pa.RecordBatch.from_pydict({name: columns[name] for name in wanted})

    return words.select("word").mapInArrow(run, schema)


def _read_backwards() -> Column:
    return F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))


def paths(words: DataFrame) -> DataFrame:
    """(side, word, path): the nodes (depth, key) of each word in both tries, from its half to its end."""
    kinds = _places(words, "key bigint, next int, start boolean").groupBy("key").agg(F.min("next").alias("least"), F.max("next").alias("most"), F.max("start").alias("start"))
    nodes = kinds.where("start or least = 0 or least < most").select("key")
    passed = _places(words, "side int, word string, depth int, key bigint").join(nodes.hint("shuffle_hash"), "key", "left_semi")
    return passed.groupBy("side", "word").agg(F.array_sort(F.collect_list(F.struct("depth", "key"))).alias("path"))


def _bits(ending: Column) -> list[Column]:
    """A signature with the one bit of an ending."""
    place = _place(ending)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place % 64)
    return [F.when(F.call_function("div", place, F.lit(64)) == k, bit) for k in range(len(SIGNATURE))]


def _place(ending: Column) -> Column:
    return F.pmod(F.xxhash64(ending), F.lit(64 * len(SIGNATURE))).cast("int")


def _may_end(place: Column) -> Column:
    """Whether a signature has the bit of an ending."""
    word = F.get(F.array(*SIGNATURE), F.call_function("div", place, F.lit(64)).cast("int"))
    return F.getbit(F.coalesce(word, F.lit(0).cast("long")), place % 64) == 1


def edges(paths: DataFrame) -> DataFrame:
    """The edges of both tries, each once: from (depth, parent) over the letters of `label` to (below, child).

    least, most: letters that words go on below it; SIGNATURE: of these endings; words: how many
    words pass; word: the one that ends there.
    """
    steps = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.struct(F.col("path")[i - 1].alias("a"), F.col("path")[i].alias("b")))
    each = paths.where(F.size("path") > 1).select("word", _read_backwards().alias("text"), F.explode(steps).alias("step"))
    each = each.select("word", "text", F.length("text").alias("q"), F.col("step.a.depth").alias("depth"), F.col("step.a.key").alias("parent"), F.col("step.b.depth").alias("below"), F.col("step.b.key").alias("child"))
    rest = F.col("q") - F.col("below")
    each = each.select(
        "depth", "parent", "below", "child",
        F.substr("text", F.col("depth") + 1, F.col("below") - F.col("depth")).alias("label"),
        rest.alias("rest"),
        *[b.alias(c) for b, c in zip(_bits(F.substr("text", F.col("below") + 1)), SIGNATURE, strict=True)],
        F.when(rest == 0, F.col("word")).alias("word"),
    )
    return each.groupBy("depth", "parent", "below", "child", "label").agg(
        F.min("rest").alias("least"), F.max("rest").alias("most"), *[F.bit_or(c).alias(c) for c in SIGNATURE], F.count("*").alias("words"), F.max("word").alias("near")
    )


def _step(states: DataFrame, level: DataFrame, depth: int) -> DataFrame:
    """The states after one edge; those that have found a neighbour have FOUND for a depth."""
    letters = F.col("below") - F.lit(depth)

    def text(begin: Column, size: Column) -> Column:
        return F.substr("text", F.col(begin) + 1 if isinstance(begin, str) else begin + 1, size)

    def lives(pos: Column, known: str | None = None) -> Column:
        """Words below go on as the word does from `pos`, as far as length and signature say; `known` has the place of
        the ending's bit if the edge has one letter, as most have.
        """
        left, place = F.col("q") - pos, _place(F.substr("text", pos + 1))
        return left.between(F.col("least"), F.col("most")) & _may_end(place if known is None else F.when(letters == 1, F.col(known)).otherwise(place))

    pos, fresh = F.col("pos"), ~F.col("edited")
    letter, wanted = F.substr("label", F.lit(1), F.lit(1)), text("pos", F.lit(1))
    same = letter == wanted
    along, swapped, put_in = pos + letters, pos + letters, pos + letters - 1
    beyond = F.substr("label", F.lit(2))
    # A word's own edge matters as long as other words pass it.
    own = same & fresh & (F.col("words") > 1) & (F.col("least") <= F.col("q") + 1 - along) & (F.col("most") >= F.col("q") - along)
    follows = same & F.col("edited") & (F.col("label") == text("pos", letters)) & lives(along)
    replaced = (letter > wanted) & fresh & (swapped <= F.col("q")) & (beyond == text(pos + 1, letters - 1)) & lives(swapped, "after")
    added = ~same & fresh & (put_in <= F.col("q")) & (beyond == text("pos", letters - 1)) & lives(put_in, "here")
    moves = F.array(
        F.when(own | follows, F.struct(along.alias("pos"), F.col("edited").alias("edited"))),
        F.when(replaced, F.struct(swapped.alias("pos"), F.lit(True).alias("edited"))),
        F.when(added, F.struct(put_in.alias("pos"), F.lit(True).alias("edited"))),
    )
    states = states.withColumns({"here": _place(F.substr("text", pos + 1)), "after": _place(F.substr("text", pos + 2))})
    met = states.join(level.hint("shuffle_hash"), (F.col("key") == F.col("parent")) & (own | follows | replaced | added))
    moved = met.withColumn("move", F.explode(F.filter(moves, lambda m: m.isNotNull())))
    done = F.col("move.edited") & (F.col("move.pos") == F.col("q"))
    after = moved.select(
        "side", "word", "q", F.col("move.pos").alias("pos"), F.col("child").alias("key"), F.col("move.edited").alias("edited"),
        F.when(done, F.col("near")).alias("near"), F.lit(depth).alias("from"), F.when(done, F.lit(FOUND)).otherwise(F.col("below")).alias("depth"),
    )
    return after.where(f"depth != {FOUND} or near is not null")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near), both ways, of the words that differ by one letter replaced, put in or left out."""
    spark = words.sparkSession
    known = stored(paths(words))
    trie = new_folder(spark)
    edges(known).hint("rebalance", "depth").write.partitionBy("depth").parquet(trie)
    # Written by depth and read by depth: a level reads its own edges and states.
    trie_edges = spark.read.schema("parent bigint, below int, child bigint, label string, least int, most int, " + ", ".join(f"{c} bigint" for c in SIGNATURE) + ", words bigint, near string, depth int").parquet(trie)
    frontier = new_folder(spark)

    def put(states: DataFrame, depth: int) -> None:
        states.drop("from").write.partitionBy("depth").parquet(f"{frontier}/from={depth}")

    q = F.length("word")
    begin = F.element_at(F.filter("path", lambda n: n["depth"] == F.call_function("div", q + F.col("side"), F.lit(2))), 1)
    empty = F.lit(None).cast("string").alias("near")
    put(known.select("side", "word", q.alias("q"), begin["depth"].alias("pos"), begin["key"].alias("key"), F.lit(False).alias("edited"), empty, F.lit(-1).alias("from"), begin["depth"].alias("depth")), -1)

    depths = sorted(r["depth"] for r in trie_edges.select("depth").distinct().collect())
    for depth in depths:
        states = spark.read.schema(STATE).option("basePath", frontier).parquet(frontier).where(F.col("depth") == depth)
        states = states.drop("depth", "from", "near").withColumn("text", _read_backwards())
        put(_step(states, trie_edges.where(F.col("depth") == depth).drop("depth"), depth), depth)
    found = spark.read.schema(STATE).option("basePath", frontier).parquet(frontier).where(F.col("depth") == FOUND)
    pairs = found.where(F.levenshtein("word", "near", 1) == 1)
    both = F.explode(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"))))
    return pairs.select(both.alias("pair")).select("pair.*").distinct()


def roots(links: DataFrame, most: int, factor: int) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last. Counts grow along them, so that they end."""
    found = links.select("word", F.col("form").alias("root"))
    longest = math.log(max(most, 1), factor) + 1
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        found = stored(found)
        on = found.select(F.col("word").alias("at"), F.col("root").alias("next"))
        found = found.join(on, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"))
    return found


def variants(counts: DataFrame, *, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of (word, n)."""
    counts = stored(counts)
    near = neighbours(counts).join(counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # Of the largest count, the first word.
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= factor * F.col("n")
    judged = stored(
        counts.join(best, "word", "left").select(
            "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, -F.col("best.less")).alias("form_n")
        )
    )
    most = counts.agg(F.max("n")).first()[0] or 0
    root = roots(judged.where("form is not null"), most, factor)
    return judged.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
