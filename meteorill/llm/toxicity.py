"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic regressions over the presence of telling
words; each model also sees the probabilities of the categories before it. While training, those
are out-of-fold predictions, made by models that have not seen the row, so that a later model does
not trust them more than it may later.

The chain is fitted on a bounded sample of the labelled documents and scores all. Null and empty
texts have no words and get the models' base rates. Repeated rows are scored alike. A category that
no or every training row has gets a constant probability; without training rows all are 0. Columns
of the documents are kept by `score`, whatever their names; what it adds comes last. Very long texts are
read whole. Words that tell equally much are taken in the order of the words; an empty table has an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.tables import let, stored, text_or_empty

#: Labelled documents, about, that the chain is fitted on.
MAX_TRAINING_ROWS = 20_000
#: Words that may be features, and how telling (chi-squared of one category) and frequent they must be.
MAX_WORDS, MIN_CHI2, MIN_DOCUMENTS = 2048, 20.0, 3
FOLDS = 3
REG_PARAM = 2e-4
FLAG = 0.5


#: A longer word also counts by its beginning, marked with a caret, so that its relatives are known by it.
BEGINNING, LONGER_THAN = 4, 5


def distinct_words(text: Column) -> Column:
    """Words of letters and digits in lower case, and the beginnings of long ones, each once."""

    def with_beginnings(words):
        long = F.filter(words, lambda w: F.length(w) > LONGER_THAN)
        return F.array_union(words, F.transform(long, lambda w: F.concat(F.lit("^"), F.substring(w, 1, BEGINNING))))

    return let(F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), ""), with_beginnings)


def training_rows(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Label columns beside the words of the documents, for about `max_rows` labelled ids at most, stored.

    Ids are chosen by hash, the same ones on any partitioning.
    """
    labels = labels.dropDuplicates(["doc_id"]).where("doc_id is not null")
    share = min(1.0, max_rows / max(1, labels.count()))
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    words = docs.select("doc_id", distinct_words(text_or_empty()).alias("words"))
    return stored(words.join(F.broadcast(chosen), "doc_id"))


def telling_words(rows: DataFrame, category: str | Column, *, min_chi2: float = MIN_CHI2, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(word, chi2, inside, outside): words that documents of the category have more often than others.

    inside and outside count documents that have the word.
    """
    category = F.col(category) if isinstance(category, str) else category
    marked = rows.select(category.cast("int").alias("y"), "words")
    positive, everything = marked.agg(F.sum("y"), F.count("*")).first()
    positive, negative = positive or 0, everything - (positive or 0)
    counted = marked.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.sum("y").alias("inside"), F.sum(1 - F.col("y")).alias("outside"))
    a, b = F.col("inside").cast("double"), F.col("outside").cast("double")
    c, d = positive - a, negative - b
    cross = a * d - b * c
    chi2 = F.try_divide(everything * cross * cross, (a + b) * (c + d) * F.lit(float(positive)) * F.lit(float(negative)))
    scored = counted.select("word", "inside", "outside", chi2.alias("chi2"), cross.alias("cross"))
    return scored.where((F.col("chi2") >= min_chi2) & (F.col("inside") + F.col("outside") >= min_documents) & (F.col("cross") > 0)).drop("cross")


def choose_vocabulary(rows: DataFrame, categories: list[str], *, max_words: int = MAX_WORDS) -> list[str]:
    """The most telling words of all categories, at most `max_words`."""
    found = None
    for category in categories:
        words = telling_words(rows, category).select("word", "chi2")
        found = words if found is None else found.unionByName(words)
    best = found.groupBy("word").agg(F.max("chi2").alias("chi2")).orderBy(F.desc("chi2"), "word").limit(max_words)
    return [r["word"] for r in best.collect()]


@dataclass(frozen=True)
class Chain:
    """Models in the order of `categories`; model k takes the words and k probabilities."""

    categories: tuple[str, ...]
    vocabulary: tuple[str, ...]
    models: tuple[LogisticRegressionModel, ...]


def _with_words(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    vectorizer = CountVectorizerModel.from_vocabulary(list(vocabulary) or [""], inputCol="words", outputCol="__present")
    return vectorizer.setBinary(True).transform(rows)


def _inputs(rows: DataFrame, earlier: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=["__present", *(f"p_{c}" for c in earlier)], outputCol="__inputs").transform(rows)


def _probability(rows: DataFrame, model: LogisticRegressionModel, category: str) -> DataFrame:
    scored = model.transform(rows).withColumn(f"p_{category}", vector_to_array("__probability")[1])
    return scored.drop("__inputs", "__raw", "__probability", "__prediction")


def fit(rows: DataFrame, categories: list[str], *, folds: int = FOLDS, reg_param: float = REG_PARAM, max_words: int = MAX_WORDS) -> Chain | None:
    """The chain for 0/1 columns `categories` of `rows`, which have `doc_id` and `words`; None without rows."""
    if rows.isEmpty():
        return None
    vocabulary = choose_vocabulary(rows, categories, max_words=max_words)
    data = _with_words(rows, vocabulary).withColumn("__fold", F.pmod(F.xxhash64("doc_id"), F.lit(folds)))
    data = stored(data.select("doc_id", "__fold", "__present", *(F.col(c).cast("double").alias(c) for c in categories)))
    models: list[LogisticRegressionModel] = []
    for k, category in enumerate(categories):
        learner = LogisticRegression(
            featuresCol="__inputs", labelCol=category, rawPredictionCol="__raw", probabilityCol="__probability", predictionCol="__prediction",
            regParam=reg_param, standardization=False, maxIter=50, family="binomial",
        )
        inputs = _inputs(data, categories[:k]).cache()
        models.append(learner.fit(inputs))
        if k + 1 < len(categories):
            apart = None
            for fold in range(folds):
                others, own = inputs.where(F.col("__fold") != fold), inputs.where(F.col("__fold") == fold)
                model = models[-1] if others.isEmpty() else learner.fit(others)
                scored = _probability(own, model, category)
                apart = scored if apart is None else apart.unionByName(scored)
            data = stored(apart)
        inputs.unpersist()
    return Chain(tuple(categories), tuple(vocabulary), tuple(models))


def score(docs: DataFrame, chain: Chain | None, categories: list[str]) -> DataFrame:
    """`docs` with a probability p_<category> for each category."""
    own = [F.col(f"`{c}`") for c in docs.columns if c not in {f"p_{c}" for c in categories}]
    if chain is None:
        return docs.select(*own, *(F.lit(0.0).alias(f"p_{c}") for c in categories))
    rows = docs.select(F.struct(*own).alias("__row"), distinct_words(text_or_empty()).alias("words"))
    rows = _with_words(rows, list(chain.vocabulary)).drop("words")
    for k, (category, model) in enumerate(zip(chain.categories, chain.models, strict=True)):
        rows = _probability(_inputs(rows, list(chain.categories[:k])), model, category)
    return rows.select("__row.*", *(f"p_{c}" for c in categories))


#: Categories of the given labels, in the order of the chain.
CATEGORIES = ["low_quality", "toxic", "severe"]
#: Different abusive words that make a toxic document a severe one.
SEVERE_WORDS = 4


def labelled(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Training rows with the categories of `labels` (quality, toxic).

    Severe are toxic documents with several of the words that almost only toxic documents have.
    """
    flags = labels.groupBy("doc_id").agg((F.min("quality") == 0).cast("int").alias("low_quality"), F.max("toxic").cast("int").alias("toxic"))
    rows = training_rows(docs, flags.na.fill(0), max_rows=max_rows)
    abusive = telling_words(rows, "toxic").where("inside > 9 * outside").orderBy(F.desc("chi2"), "word").limit(MAX_WORDS)
    words = [r["word"] for r in abusive.collect()]
    several = F.size(F.array_intersect("words", F.array(*map(F.lit, words)).cast("array<string>"))) >= SEVERE_WORDS
    return rows.withColumn("severe", (several & (F.col("toxic") == 1)).cast("int"))


def judge(docs: DataFrame, labels: DataFrame, *, flag: float = FLAG) -> DataFrame:
    """`docs` with p_low_quality, p_toxic, p_severe and flagged: whether toxic or severe is likely."""
    chain = fit(labelled(docs, labels), CATEGORIES)
    return score(docs, chain, CATEGORIES).withColumn("flagged", F.greatest("p_toxic", "p_severe") >= flag)
