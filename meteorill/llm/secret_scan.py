"""Secrets in text, told apart from published examples by who else has them.

Candidates are found in every whole text; of their values only hashes leave the task. Over the
corpus, the distinct repositories and owners of each hash are counted: a value that several owners
have is a copied example, a value of few owners looks live. Long mixed tokens without any keyword
beside them count as secrets only if they look live that way.

Null and empty texts have no candidates. A null owner or repository is one of its own. Repeated
rows add neither owners nor repositories. Offsets are code points, ends exclusive. Very long texts are read
whole. Spans that start together are in the order of the kinds. Names of further columns do no harm; an empty table has an
empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.tables import bounded, stored, text_or_empty

# What each kind looks like. Letters of the keywords may be in either case.
KINDS = ("assign", "access", "hex", "generic")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
KEYWORDS = ("password", "passwd", "secret", "token", "api")
#: Runs long enough, each begun at its first character.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
GENERIC = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
MIN_ASSIGNED = 6
#: Bits of entropy in each character of a token without a keyword.
MIN_ENTROPY = 3.5

Span = tuple[str, int, int, str]


def _entropy(value: str) -> float:
    counts = (value.count(c) for c in set(value))
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts)


def base_spans(text: str) -> list[Span]:
    """(kind, start, end, value), leftmost and non-overlapping within each kind, in order."""
    spans: list[Span] = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        spans += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def generic_spans(text: str, taken: list[Span]) -> list[Span]:
    """Long tokens of letters and digits, mixed enough, that touch none of the spans `taken`."""
    found: list[Span] = []
    for m in GENERIC.finditer(text):
        value = m[0]
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and _entropy(value) >= MIN_ENTROPY
        if mixed and all(m.end() <= s or e <= m.start() for _, s, e, _ in taken):
            found.append(("generic", m.start(), m.end(), value))
    return found


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:8], "big", signed=True)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_hash", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch["text"].to_pylist():
            base = base_spans(text)
            spans = sorted(base + generic_spans(text, base), key=lambda s: (s[1], KINDS.index(s[0])))
            rows.append([{"kind": k, "start": s, "end": e, "value_hash": _hash(v)} for k, s, e, v in spans])
        kept = batch.drop_columns("text")
        yield kept.append_column("spans", pa.array(rows, pa.list_(SPAN)))


def find_candidates(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """(row, doc_id, text_hash, owner, repository, spans) of every document, stored."""
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), text_or_empty().alias("text")
    )
    schema = "doc_id {}, text_hash bigint, owner string, repository string, spans array<struct<kind:string,start:int,end:int,value_hash:bigint>>"
    return stored(texts.mapInArrow(_scan, schema.format(docs.schema["doc_id"].dataType.simpleString())).withColumn("row", F.monotonically_increasing_id()))


def ownership(candidates: DataFrame) -> DataFrame:
    """(value_hash, n_owners, n_repositories). A hash in many rows shrinks to one for each owner before it is counted."""
    places = candidates.select("owner", "repository", F.inline("spans")).select("value_hash", "owner", "repository").distinct()
    owners = places.groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
    return owners.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def judge(candidates: DataFrame, *, max_owners: int = 1) -> DataFrame:
    """(row, doc_id, text_hash, spans) of every document; each span has n_owners, n_repositories and
    live: whether at most `max_owners` owners have its value. Generic spans that do not look live are gone.
    """
    known = ownership(candidates).withColumn("live", F.col("n_owners") <= max_owners)
    spans = candidates.select("row", F.inline("spans")).join(known, "value_hash").where("live or kind <> 'generic'")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "end", "kind", "value_hash", "n_owners", "n_repositories", "live")
    by_row = spans.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("judged"))
    nothing = F.array().cast(by_row.schema["judged"].dataType)
    joined = candidates.select("row", "doc_id", "text_hash").join(by_row, "row", "left")
    return joined.select("row", "doc_id", "text_hash", F.coalesce("judged", nothing).alias("spans"))


def rendered(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, judged: DataFrame, *, mark: str = "<secret>", max_broadcast_rows: int = 200_000) -> DataFrame:
    """`docs` with every span of `judged` replaced by `mark`, overlapping ones together, and
    n_chars, if there is such a column, counted anew. Texts without spans stay as they are, null ones too.
    """
    wanted = stored(judged.where("size(spans) > 0").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans")).dropDuplicates(["__id", "__hash"]))
    small = bounded(wanted, wanted.agg(F.sum(F.size("__spans"))).first()[0] or 0, max_broadcast_rows)
    same = docs["doc_id"].eqNullSafe(small["__id"]) & (F.xxhash64(docs["text"]) == small["__hash"])

    def cut(state, span):
        fresh = F.when(span["start"] >= state["at"], F.concat(state["text"], F.substring(F.col("text"), state["at"] + 1, span["start"] - state["at"]), F.lit(mark))).otherwise(state["text"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), fresh.alias("text"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    whole = F.aggregate("__spans", start, cut, lambda s: F.concat(s["text"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    joined = docs.join(small, same, "left")
    text = F.when(F.col("__spans").isNull(), docs["text"]).otherwise(whole)
    result = joined.select(*(text.alias(c) if c == "text" else docs[c] for c in docs.columns))
    return result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else result
