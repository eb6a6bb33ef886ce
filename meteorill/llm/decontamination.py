"""Benchmark decontamination over a distributed positional inverted index.

The index holds a posting (term, document, position) for every word of the corpus that some
benchmark item uses. For each window of an item its rarest terms are looked up; their postings,
shifted by the terms' places in the item, meet where the item may occur, and only there are the
words themselves compared. Proximity matches use the same lists with some slack: a window is near where, laid
on the document at some place, each of its words stands at most `slack` words from its own place. Words put
in or left out between them, and words that have changed places, are found so.

Everything is built-in functions. Null and empty texts have no words and are never hit. Repeated
rows and equal ids are told apart by their text; fully equal rows get equal results. Items without
words have no windows; an item whose id is null counts as one with an empty id. Terms of one frequency are taken in
the order of their places. Very long texts have more postings and nothing else; what a document is cut to is its candidates'
places. Empty documents give an empty result, an empty benchmark hits nothing. Columns of the documents
besides doc_id and text play no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meteorill.llm.tables import ascii_lower, bounded, let, stored, text_or_empty

#: What stands between two words of a lower-cased text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Terms looked up for each window.
RAREST = 2
#: Words by which a word of a near window may be off its place.
SLACK = 3
#: Rows up to which a side may be broadcast: terms of the benchmark, or candidates of a few numbers each.
MAX_BROADCAST_ROWS = 200_000

DOCUMENT = ["doc_id", "text_hash"]


def text_words(column: str = "text") -> Column:
    return F.array_remove(F.split(ascii_lower(text_or_empty(column)), GAP), "")


@dataclass(frozen=True)
class Index:
    """`postings`: (term, doc_id, text_hash, position); `items`: (item, item_id, words); `terms`: (item, place, term)."""

    postings: DataFrame
    items: DataFrame
    terms: DataFrame


def build_index(docs: DataFrame, benchmark: DataFrame, *, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> Index:
    """The index of `docs` (doc_id, text) for the items of `benchmark` (item_id, text), stored.

    The dictionary of the items' words is broadcast if it has been counted to be small; else the
    corpus's words are shuffled to it.
    """
    items = stored(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), text_words().alias("words"))
        .where(F.size("words") > 0)
        .distinct()
        .withColumn("item", F.monotonically_increasing_id())
    )
    places = items.select("item", F.posexplode("words").alias("place", "word"))
    dictionary = stored(places.select("word").distinct().withColumn("term", F.monotonically_increasing_id()))
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(text_words()).alias("position", "word"))
    small = bounded(dictionary, dictionary.count(), max_broadcast_rows)
    postings = stored(words.join(small, "word").select("term", *DOCUMENT, "position"))
    return Index(postings, items, stored(places.join(dictionary, "word").select("item", "place", "term")))


def _anchors(index: Index, window: int, rarest: int) -> DataFrame:
    """(item, start, place, term): the rarest terms of each window, all if it has no more words."""
    frequency = index.postings.groupBy("term").agg(F.count("*").alias("frequency"))
    sizes = index.items.select("item", F.size("words").alias("size"))
    placed = index.terms.join(frequency, "term", "left").join(sizes, "item")
    first = F.greatest(F.lit(0), F.col("place") - (window - 1))
    last = F.least(F.col("place"), F.greatest(F.lit(0), F.col("size") - window))
    starts = placed.select("item", "place", "term", F.coalesce("frequency", F.lit(0)).alias("frequency"), F.explode(F.sequence(first, last)).alias("start"))
    order = Window.partitionBy("item", "start").orderBy("frequency", "place")
    return starts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rarest).select("item", "start", "place", "term")


def candidates(index: Index, *, window: int = WINDOW, rarest: int = RAREST, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_hash, item, shift): where the words of a window may stand, stored.

    Word p of the item would be word `shift + p` of the document. Each list of postings meets the
    others of its window under the key (item, document, shift), which no hot term or document fills.
    """
    windows = stored(_anchors(index, window, rarest))
    anchors = stored(windows.select("item", "place", "term").distinct())
    needed = windows.groupBy("item", "start").agg(F.count("*").alias("n")).groupBy("item").agg(F.min("n").alias("needed"))
    shifted = index.postings.join(bounded(anchors, anchors.count(), max_broadcast_rows), "term")
    met = shifted.groupBy("item", *DOCUMENT, (F.col("position") - F.col("place")).alias("shift")).agg(F.count("*").alias("met"))
    return stored(met.join(needed, "item").where("met >= needed").select(*DOCUMENT, "item", "shift"))


def near_candidates(index: Index, *, slack: int = SLACK, window: int = WINDOW, rarest: int = RAREST, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_hash, item, bin): where the words of some window of an item may stand within `slack` of their places, stored.

    If word p of the item stands at most `slack` from `shift + p`, its own shift is in a range of 2 * slack + 1 around
    that of the window. Bins of twice this width overlap by half, so that the shifts of all rarest terms lie in one of
    them. There the terms' places are gathered as bits, modulo 64, which tells apart those of a window.
    """
    windows = stored(_anchors(index, window, rarest))
    anchors = stored(windows.select("item", "place", "term").distinct())
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place") % 64)
    masks = windows.groupBy("item", "start").agg(F.bit_or(bit).alias("mask")).groupBy("item").agg(F.collect_set("mask").alias("masks"))
    width = 2 * slack + 1
    bins = F.array(*(F.call_function("div", F.col("shift") - F.pmod("shift", F.lit(width)), F.lit(width)) - k for k in (0, 1)))
    shifted = index.postings.join(bounded(anchors, anchors.count(), max_broadcast_rows), "term").select("item", *DOCUMENT, bit.alias("bit"), (F.col("position") - F.col("place")).alias("shift"))
    met = shifted.select("item", *DOCUMENT, "bit", F.explode(bins).alias("bin")).groupBy("item", *DOCUMENT, "bin").agg(F.bit_or("bit").alias("met"))
    # One place is not enough for most windows: those go before the items' windows are looked at.
    whole = F.exists("masks", lambda m: m.bitwiseAND(F.col("met")) == m)
    return stored(met.join(masks, "item").where(whole).select(*DOCUMENT, "item", "bin"))


def _hit_positions(window: int) -> Column:
    """Positions in the document of words inside matching windows, from `seen` aligned with the item's words."""
    size = F.least(F.lit(window), F.size("words"))
    skipped = F.greatest(F.lit(0), -F.col("shift"))
    same = F.transform(F.col("seen"), lambda word, k: F.get(F.col("words"), skipped + k) == word)

    def hits(equal):
        starts = F.sequence(F.lit(0), F.size(equal) - size)
        whole = F.filter(starts, lambda s: F.forall(F.slice(equal, s + 1, size), lambda x: x))
        first = F.col("shift") + skipped
        return F.array_distinct(F.flatten(F.transform(whole, lambda s: F.sequence(first + s, first + s + size - 1))))

    return F.when(F.size("seen") >= size, let(same, hits)).otherwise(F.array().cast("array<int>"))


def _is_near(window: int, slack: int) -> Column:
    """Whether some shift puts every word of some window of `words` near its place in `seen`. That begins where the least
    shift puts the item's first word, less the slack; `skipped` words of it lie before the document.
    """
    size = F.least(F.lit(window), F.size("words"))
    # All shifts of a bin, and of what its terms may be off.
    shifts = F.sequence(F.lit(-slack), F.lit(2 * (2 * slack + 1) + slack))
    starts = F.sequence(F.lit(0), F.size("words") - size)

    def close(s, p):
        # Word p stands from `slack` before to `slack` behind its place under shift s.
        place = s + p - F.col("skipped") + 2 * slack
        begin = F.greatest(place - slack, F.lit(0))
        return F.array_contains(F.slice("seen", begin + 1, F.greatest(place + slack - begin + 1, F.lit(0))), F.get(F.col("words"), p))

    def along(s):
        """Which words are close under shift s; a window is near if all of its words are."""
        each = F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda p: close(s, p))
        return let(each, lambda known: F.exists(starts, lambda start: F.forall(F.slice(known, start + 1, size), lambda x: x)))

    return F.exists(shifts, along)


def matches(
    docs: DataFrame, index: Index, found: DataFrame, near: DataFrame | None, *, slack: int = SLACK, window: int = WINDOW, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Every document with n_words, hits (positions), item_ids and near_ids (sorted), in rows of
    (row, doc_id, text_hash, n_words, hits, item_ids, near_ids); `found` and `near` are the candidates. Without `near`
    nothing is near.

    Each document's words are read once more, beside the candidates they are cut to.
    """
    n_found = found.count()
    every = found.join(index.items.select("item", F.size("words").alias("size")), "item").select(*DOCUMENT, "item", "shift", "size", F.lit(False).alias("near"))
    if near is not None:
        # The words that an item may reach under any shift of its bin.
        width = 2 * slack + 1
        reach = (F.size("words") + 2 * width + 4 * slack + 1).alias("size")
        close = near.join(index.items.select("item", "words"), "item").select(*DOCUMENT, "item", (F.col("bin") * width - 2 * slack).cast("int").alias("shift"), reach, F.lit(True).alias("near"))
        every, n_found = every.unionByName(close), n_found + near.count()
    wanted = every.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("item", "shift", "size", "near")).alias("wanted"))
    wanted = stored(wanted.select(F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"), "wanted"))

    def cut(words):
        def piece(c):
            skipped = F.greatest(F.lit(0), -c["shift"])
            seen = F.slice(words, c["shift"] + skipped + 1, F.greatest(c["size"] - skipped, F.lit(0)))
            return F.struct(c["item"].alias("item"), c["shift"].alias("shift"), c["near"].alias("near"), skipped.alias("skipped"), seen.alias("seen"))

        return F.struct(F.size(words).alias("n_words"), F.transform("wanted", piece).alias("pieces"))

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    small = bounded(wanted, n_found, max_broadcast_rows)
    both = texts.join(small, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_hash") == F.col("at_hash")), "left")
    rows = stored(both.select(*DOCUMENT, let(text_words(), cut).alias("cut")).select(*DOCUMENT, F.col("cut.n_words").alias("n_words"), F.col("cut.pieces").alias("pieces")).withColumn("row", F.monotonically_increasing_id()))
    pieces = rows.where("size(pieces) > 0").select("row", F.inline("pieces")).join(index.items, "item")
    close_by = pieces.where("near").where(_is_near(window, slack)).groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("near_ids"))
    matched = pieces.where("not near").select("row", "item_id", _hit_positions(window).alias("hits")).where("size(hits) > 0")
    matched = matched.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
    )
    nothing = F.array().cast("array<int>"), F.array().cast("array<string>")
    return rows.drop("pieces").join(matched, "row", "left").join(close_by, "row", "left").select(
        "row", *DOCUMENT, "n_words", F.coalesce("hits", nothing[0]).alias("hits"), F.coalesce("item_ids", nothing[1]).alias("item_ids"), F.coalesce("near_ids", nothing[1]).alias("near_ids")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, rarest: int = RAREST, slack: int | None = SLACK) -> DataFrame:
    """Exact phrase and proximity matches of benchmark windows in every document; see `matches`. Exact ones only if `slack` is None."""
    index = build_index(docs, benchmark)
    found = candidates(index, window=window, rarest=rarest)
    if slack is None:
        return matches(docs, index, found, None, window=window)
    return matches(docs, index, found, near_candidates(index, slack=slack, window=window, rarest=rarest), slack=slack, window=window)


def keep_clean(docs: DataFrame, matches: DataFrame, *, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """`docs` without those that `matches` finds hit."""
    hit = stored(matches.where("size(hits) > 0").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    small = bounded(hit, hit.count(), max_broadcast_rows)
    return docs.join(small, docs["doc_id"].eqNullSafe(small["__id"]) & (F.xxhash64(docs["text"]) == small["__hash"]), "left_anti")
