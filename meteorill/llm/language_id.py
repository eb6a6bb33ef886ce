"""Language of a text by the nearest of several centroids for each language.

A text becomes a vector of its hashed character n-grams, weighted by TF-IDF and of length one.
Document frequencies are counted over all training texts; the centroids of a language come from
spherical k-means over a bounded sample of its training texts. The language is that of the centroid
with the largest cosine; a text further from it than nearly all of that cluster's own texts were is
marked as rejected.

A null text, or one without a letter, is `und` with score 0 and rejected. So is every text if nothing
could be learned. Rows without a language are not learned from; repeated rows count as often as they
occur. Ties between centroids go to the first language in order. Texts are taken whole, very long ones,
too. Columns to keep are named by the caller, others play no part; an empty table has an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.tables import bounded, stored

UNKNOWN = "und"
N = 3
DIMENSIONS = 4096
#: Training texts of a language, about, that its centroids are fitted to.
SAMPLE = 800
CENTROIDS = 4
#: Share of a cluster's own texts that may lie outside its radius.
OUTSIDE = 0.01
CHUNK = 256
MAX_BROADCAST_ROWS = 200_000

#: Letters of ASCII in lower case, all other ASCII as space; bytes of other characters as they are.
_PLAIN = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngram_counts(text: str | None, dimensions: int = DIMENSIONS, n: int = N) -> np.ndarray:
    """How often each hashed n-gram of bytes occurs, lower-cased and with a space at either end."""
    plain = b" ".join([b"", *(text or "").lower().encode("utf-8", "replace").translate(_PLAIN).split(), b""])
    data = np.frombuffer(plain, dtype=np.uint8).astype(np.uint32)
    if len(data) < n:
        return np.zeros(dimensions, dtype=np.float32)
    grams = np.zeros(len(data) - n + 1, dtype=np.uint32)
    for k in range(n):
        grams = grams * np.uint32(257) + data[k : len(data) - n + 1 + k]
    hashed = (grams * np.uint32(2654435761)) >> np.uint32(16)
    return np.bincount(hashed % dimensions, minlength=dimensions).astype(np.float32)


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """A row of length one for each text, or of zeros."""
    weighted = np.stack([np.log1p(ngram_counts(t, len(idf))) for t in texts]) * idf
    norms = np.linalg.norm(weighted, axis=1, keepdims=True)
    return np.divide(weighted, norms, out=np.zeros_like(weighted), where=norms > 0)


def document_frequencies(train: DataFrame, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, int]:
    """In how many of all texts of `train` each n-gram occurs, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(dimensions, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                seen += ngram_counts(text, dimensions) > 0
                rows += 1
        if rows:
            yield pa.RecordBatch.from_pydict({"place": np.arange(dimensions + 1), "n": np.append(seen, rows)})

    summed = train.select("text").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    found = np.zeros(dimensions + 1, dtype=np.int64)
    for row in summed.collect():
        found[row["place"]] = row["n"]
    return found[:-1], int(found[-1])


def _clusters(points: np.ndarray, count: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out beginnings: centroids of length one, and each point's cosine to its own."""
    chosen = [points.mean(axis=0)]
    chosen[0] = points[np.argmax(points @ chosen[0])]
    while len(chosen) < min(count, len(points)):
        nearest = np.max(points @ np.stack(chosen).T, axis=1)
        chosen.append(points[np.argmin(nearest)])
    centroids = np.stack(chosen)
    for _ in range(rounds):
        own = np.argmax(points @ centroids.T, axis=1)
        for k in range(len(centroids)):
            total = points[own == k].sum(axis=0)
            if norm := np.linalg.norm(total):
                centroids[k] = total / norm
    return centroids, points @ centroids.T


@dataclass(frozen=True)
class Model:
    """`centroids` row k belongs to `languages[k]`; a text nearer than `radii[k]` in cosine is of it."""

    languages: tuple[str, ...]
    centroids: np.ndarray
    radii: np.ndarray
    idf: np.ndarray


def drawn(train: DataFrame, sample: int) -> DataFrame:
    """(lang, text, copies): about `sample` rows of each language, the same whatever the partitions. Stored.

    Of equal texts as many copies are drawn as their share allows, rounded by the text's hash, so that
    the sample keeps its size however often a text occurs. Texts are taken as equal if their hash is.
    """
    hashed = train.select("lang", "text", F.xxhash64("text").alias("hash"))
    distinct = stored(hashed.groupBy("lang", "hash").agg(F.count("*").alias("rows")))
    counts = stored(distinct.groupBy("lang").agg(F.sum("rows").alias("count")))
    counts = bounded(counts, counts.count(), 10_000)
    unit = F.pmod("hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("count"))
    copies = stored(distinct.join(counts, "lang").select("lang", "hash", F.ceil(F.col("rows") * share - unit).alias("copies")).where("copies > 0"))
    copies = bounded(copies, copies.count(), MAX_BROADCAST_ROWS)
    return stored(hashed.join(copies, ["lang", "hash"]).groupBy("lang", "hash", "copies").agg(F.min("text").alias("text")).select("lang", "text", "copies"))


def learn(train: DataFrame, *, sample: int = SAMPLE, centroids: int = CENTROIDS, dimensions: int = DIMENSIONS) -> Model:
    """A model from rows of (text, lang).

    One task fits a language's centroids to its sample; see `drawn`.
    """
    train = train.where("text is not null and lang is not null").select("text", "lang")
    seen, rows = document_frequencies(train, dimensions)
    idf = np.log((1 + rows) / (1 + seen)).astype(np.float32)
    few = drawn(train, sample)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        points = np.repeat(vectors(group["text"].tolist(), idf), group["copies"], axis=0)
        points = points[np.linalg.norm(points, axis=1) > 0]
        if not len(points):
            points = np.zeros((1, len(idf)), dtype=np.float32)  # left out below
        found, cosines = _clusters(points, centroids)
        own = np.argmax(cosines, axis=1)
        radii = [float(np.quantile(cosines[own == k, k], OUTSIDE)) if (own == k).any() else 1.0 for k in range(len(found))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": [c.tolist() for c in found], "radius": radii})

    fitted = few.groupBy("lang").applyInPandas(fit, "lang string, centroid array<float>, radius double").collect()
    fitted = [r for r in fitted if any(r["centroid"])]
    fitted.sort(key=lambda r: (r["lang"], r["radius"], r["centroid"]))
    matrix = np.array([r["centroid"] for r in fitted], dtype=np.float32).reshape(len(fitted), dimensions)
    return Model(tuple(r["lang"] for r in fitted), matrix, np.array([r["radius"] for r in fitted]), idf)


def predict(docs: DataFrame, model: Model, *, keep: list[Column | str] = ("doc_id",)) -> DataFrame:
    """`keep` columns of every row of `docs`, with lang_pred, score (cosine, 0 to 1) and rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["__text"].to_pylist()
            names, scores, far = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            known = [k for k, t in enumerate(texts) if has_letter(t)] if model.languages else []
            for begin in range(0, len(known), CHUNK):
                part = known[begin : begin + CHUNK]
                cosines = vectors([texts[k] for k in part], model.idf) @ model.centroids.T
                best = np.argmax(cosines, axis=1)
                value = cosines[np.arange(len(part)), best]
                scores[part] = np.clip(value, 0, 1)
                far[part] = value < model.radii[best]
                for k, b in zip(part, best.tolist(), strict=True):
                    names[k] = model.languages[b]
            out = batch.drop_columns("__text")
            out = out.append_column("lang_pred", pa.array(names, pa.string()))
            yield out.append_column("score", pa.array(scores)).append_column("rejected", pa.array(far))

    kept = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")
