"""The queries of this subpackage: each applies one operator to a whole given table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteorill.llm import decontamination, hard_negatives, jaccard_join, language_id, language_model, packing, quality_rules, resharding, secret_scan, spelling, suffix_dedup, toxicity, url_filter
from meteorill.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# The rules every url is judged by, and the words that open a bait host's label.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]
BAIT_HOST = r"(^|\.)(spam|ads|adult|cheap|free)-"


@query
def op4_url_filters(spark, sf_dir):
    """Every url of `pages`; listed are the pages of hosts with a bait label."""
    pages = table(spark, sf_dir, "pages")
    host, path = url_filter.url_host(F.col("url")), url_filter.url_path(F.col("url"))
    universe = pages.select(F.concat(host, path).alias("key"), host.rlike(BAIT_HOST).alias("listed"))
    return url_filter.judge(pages, url_filter.build_cascade(universe), URL_RULES)


@query
def op5_quality_rules(spark, sf_dir):
    """A decision list learned from `labels.quality`, over the statistics of every document."""
    statistics = quality_rules.text_statistics(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    rules = quality_rules.learn(statistics.where(~quality_rules.base_failed()).join(labels, "doc_id"))
    judged = quality_rules.judge(statistics, rules)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")


@query
def op2_benchmark_decontamination(spark, sf_dir):
    """Words of every document inside occurrences of ten-word windows of `benchmark`, and the items with windows whose words
    stand near each other in it.
    """
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("hits").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size("near_ids").cast("long").alias("n_near_items"),
        F.sha2(F.array_join("near_ids", ","), 256).alias("near_sha256"),
    )


@query
def op10_secret_scans(spark, sf_dir):
    """Secrets of every document; its source is the owner, and a source's language a repository."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.find_candidates(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    spans, base = F.col("spans"), F.filter("spans", lambda s: s["kind"] != "generic")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secret_scan.judge(found).select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secret_scan.rendered(base), 256).alias("base_sha256"),
        secret_scan.rendered(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
    )


@query
def op9_packing(spark, sf_dir):
    """All of `documents` in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_resharding(spark, sf_dir):
    """`documents` from 32 shards by text, which copies make uneven, to 40 of equal bytes."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64("text"), F.lit(32))
    written = resharding.rewrite(docs.select("doc_id", "text"), old, resharding.plan_resharding(docs, old, 40))
    return written.select(
        "doc_id",
        resharding.document_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "moved",
    )


@query
def op7_language_id(spark, sf_dir):
    """The language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True)).alias("held_out")
    model = language_id.learn(docs.where(~held_out))
    return language_id.predict(docs, model, keep=["doc_id", held_out])


@query
def op1_toxicity(spark, sf_dir):
    """Probabilities of the chain for every document, and whether it is toxic."""
    docs = table(spark, sf_dir, "documents")
    judged = toxicity.judge(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *(f"p_{c}" for c in toxicity.CATEGORIES), F.col("flagged").alias("toxic"))


@query
def op8_ngram_jaccard_join(spark, sf_dir):
    """The component of every document under links of 80 percent similarity of five-word shingles."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_suffix_array_dedup(spark, sf_dir):
    """What is left of every document without strings of 100 bytes that start earlier, too."""
    found = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_lm_scoring(spark, sf_dir):
    """Log probabilities of every document, learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(True))
    learned = language_model.learn(docs.where(~held_out))
    scored = language_model.score(docs.withColumn("held_out", held_out), learned, ("doc_id", "held_out"))
    train_tokens = F.lit(learned.n_tokens).cast("long").alias("train_tokens")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", train_tokens, "base_score", "score", "bits_per_byte")


@query
def op12_hard_negative_mining(spark, sf_dir):
    """Hard negatives of every hundredth vector; labels of every seventh are moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def _without_one(doc_id) -> Callable[[bytes], bytes]:
    """One in 31 of a document's words loses a letter, both by the checksum of id and word."""
    begun = zlib.crc32(f"{doc_id}:".encode())

    def change(word: bytes) -> bytes:
        chance = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), begun)
        if chance % 31:
            return word
        lost = chance % len(word)
        return word[:lost] + word[lost + 1 :]

    return change if doc_id is not None else bytes


@query
def op13_spelling_variants(spark, sf_dir):
    """Words of all documents, some with a letter lost, and the much more frequent words one letter away."""
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), change=_without_one))
