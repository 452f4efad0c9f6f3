"""Toxicity by cumulative-link ordinal regression.

Severity grades 0..K share one weight vector over sparse word features x; ordered
thresholds t_1 < ... < t_K give P(grade >= k) = sigmoid(w x - t_k), and the expected
severity is the sum of these.  Features are the presence of words that the labels tell
apart (chi-squared over the training rows, for every threshold).  A training row weighs one over
the sum of its likenesses to the rows of its grade, itself included, so that the many copies and
near copies of one text weigh about one together and no row is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tillwork.llm.spark_util import free_name, materialise
from tillwork.llm.words import NON_LETTERS, U, Words, distinct_pairs, mix, row_chunks, shingles, utf8

#: labelled rows that the fit uses at most: those with the least hash of their doc_id
TRAIN_ROWS = 20_000
FEATURES, LEAST_DOCS, LEAST_CHI2 = 1024, 5, 30.0
STEPS, RATE, RIDGE = 400, 0.1, 0.1
#: min-hashes of 5-word shingles from which likenesses are estimated: the mean count of rows that agree in one
COPY_HASHES = 8
NAMES = ("severity", "grade", "toxic")


@dataclass(frozen=True)
class OrdinalModel:
    vocabulary: np.ndarray  # word hashes, ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending
    toxic_from: int  # the least grade that counts as toxic

    def at_least(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """(n, K) probabilities of grade >= k from the (text, feature) pairs."""
        z = np.bincount(doc, self.weights[feature], n) if len(doc) else np.zeros(n)
        return _sigmoid(z[:, None] - self.thresholds)

    def score(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(expected severity, grade) of each text of an Arrow string array; the grade is the
        highest that is at least as likely as not."""
        raw, off = utf8(texts)
        words = Words(raw, off, NON_LETTERS, lower=True)
        value = words.hash.view(np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, value), max(len(self.vocabulary) - 1, 0))
        known = self.vocabulary[at] == value if len(self.vocabulary) else np.zeros(len(value), bool)
        p = self.at_least(*distinct_pairs(words.doc[known], at[known]), len(texts))
        return p.sum(axis=1), (p >= 0.5).sum(axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit_ordinal(doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, n_features: int, grades: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by full-batch gradient steps on the ridge-penalised likelihood;
    gaps between thresholds are exponentials, so they stay in order."""
    n = len(grade)
    weight = np.ones(n) if weight is None else weight
    total = weight.sum()
    share = [(np.sum(weight * (grade >= k)) + 0.5) / (total + 1) for k in range(1, grades + 1)]
    first = -np.log(share / (1 - np.array(share)))
    theta = np.concatenate((np.zeros(n_features), first[:1], np.log(np.maximum(np.diff(first), 1e-2))))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, t = theta[:n_features], np.cumsum(np.concatenate((theta[n_features : n_features + 1], np.exp(theta[n_features + 1 :]))))
        z = np.bincount(doc, w[feature], n) if len(doc) else np.zeros(n)
        above = np.column_stack((np.ones(n), _sigmoid(z[:, None] - t), np.zeros(n)))
        slope = above * (1 - above)
        row = np.arange(n)
        p = np.maximum(above[row, grade] - above[row, grade + 1], 1e-12)
        dz = -weight * (slope[row, grade] - slope[row, grade + 1]) / p
        dt = np.zeros((n, grades + 2))
        dt[row, grade] += slope[row, grade] / p
        dt[row, grade + 1] -= slope[row, grade + 1] / p
        dt = (weight[:, None] * dt[:, 1:-1]).sum(axis=0)
        gaps = np.cumsum(dt[::-1])[::-1]
        gaps[1:] *= np.exp(theta[n_features + 1 :])
        grad = np.concatenate((np.bincount(feature, dz[doc], n_features) + RIDGE * w, gaps)) / total
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta = theta - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:n_features], np.cumsum(np.concatenate((theta[n_features : n_features + 1], np.exp(theta[n_features + 1 :]))))


def word_features(docs: DataFrame) -> DataFrame:
    """(grade, text_hash, copies, features) of ``docs(text, grade)``: features are the distinct
    words' hashes, copies the min-hashes of the shingles."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, off = utf8(batch.column(0))
            for lo, hi in row_chunks(off):
                words = Words(raw, off[lo : hi + 1], NON_LETTERS, lower=True)
                doc, value = distinct_pairs(words.doc, words.hash)
                ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=hi - lo)))).astype(np.int32)
                of, shingle = shingles(Words(raw, off[lo : hi + 1], lower=True), 5)
                least = np.full((COPY_HASHES, hi - lo), -1, np.int64).view(U)
                for k in range(COPY_HASHES):
                    np.minimum.at(least[k], of, mix(shingle ^ mix(np.full(1, k + 1, U))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.FixedSizeListArray.from_arrays(pa.array(least.T.ravel().view(np.int64)), COPY_HASHES).cast(pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(value.view(np.int64)))], ["grade", "text_hash", "copies", "features"])

    return docs.select("text", "grade", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "grade int, text_hash long, copies array<long>, features array<long>")


def fit_toxicity(docs: DataFrame, labels: DataFrame, grade: Column, grades: int, toxic_from: int, id_col: str = "doc_id", text_col: str = "text",
                 train_rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``train_rows`` labelled rows; ``grade`` is a column over ``labels`` with
    values 0..grades.  Null grades, ids and texts are left out, equal (text, grade) rows share
    one weight; without labelled rows every text has grade 0."""
    picked = (labels.select(F.col(id_col).cast("long").alias("doc_id"), grade.cast("int").alias("grade"))
              .where("doc_id IS NOT NULL AND grade IS NOT NULL").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(train_rows))
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    rows = word_features(text.join(F.broadcast(picked), "doc_id").select("text", "grade"))
    rows = materialise(rows)
    # rows that agree in a min-hash and the grade, for every hash; texts alone, without their words
    texts = rows.groupBy("grade", "text_hash", "copies").agg(F.count("*").alias("m")).select("grade", "text_hash", "m", F.posexplode("copies").alias("k", "copy"))
    agree = texts.groupBy("grade", "k", "copy").agg(F.sum("m").alias("n"))
    weights = texts.join(agree, ["grade", "k", "copy"]).groupBy("grade", "text_hash").agg((COPY_HASHES / F.sum("n")).alias("weight"))
    rows = rows.drop("copies").join(F.broadcast(materialise(weights)), ["grade", "text_hash"])  # train_rows at most
    count = rows.agg(F.sum("weight"), *(F.sum(F.when(F.col("grade") >= k, F.col("weight"))) for k in range(1, grades + 1))).first()
    share = [(c or 0.0) / count[0] if count[0] else 0.0 for c in count[1:]]
    p = share[toxic_from - 1]
    if not 0 < p < 1:
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.linspace(-20.0 if p else 20.0, 21.0, grades), toxic_from)
    above = lambda k: F.sum(F.when(F.col("grade") >= k, F.col("weight")).otherwise(0.0))
    apart = [(F.col(f"hits{k}") - F.col("n") * q) ** 2 / (F.col("n") * (q * (1 - q))) for k, q in enumerate(share, 1) if 0 < q < 1]
    stats = (rows.select("grade", "weight", F.explode("features").alias("word"))
             .groupBy("word").agg(F.sum("weight").alias("n"), *(above(k).alias(f"hits{k}") for k in range(1, grades + 1)))
             .withColumn("chi2", F.greatest(*apart, F.lit(0.0))))
    words = sorted(r[0] for r in stats.where((F.col("n") >= LEAST_DOCS) & (F.col("chi2") >= LEAST_CHI2))
                   .orderBy(F.desc("chi2"), "word").limit(FEATURES).select("word").collect())
    chosen = F.array(*(F.lit(w) for w in words)) if words else F.array().cast("array<long>")
    train = rows.select("grade", "weight", "text_hash", F.array_intersect("features", chosen).alias("features")).orderBy("text_hash", "grade").collect()
    vocabulary = np.array(words, np.int64)
    doc = np.repeat(np.arange(len(train)), [len(r.features) for r in train])
    feature = np.searchsorted(vocabulary, np.array([w for r in train for w in r.features], np.int64))
    weights, thresholds = fit_ordinal(doc, feature, np.array([r.grade for r in train]), len(vocabulary), grades, np.array([r.weight for r in train]))
    return OrdinalModel(vocabulary, weights, thresholds, toxic_from)


def score_toxicity(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``severity double, grade int, toxic boolean`` (underscores appended where
    ``docs`` has such a column): expected severity, the highest grade at least as likely as
    not, and whether that is the model's least toxic grade or above.  A null or empty text has no features; equal rows get
    equal results; other columns stay as they are."""
    columns, names = docs.columns, free_name(docs, *NAMES)
    place = columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for lo, hi in row_chunks(utf8(batch.column(place))[1]):
                part = batch.slice(lo, hi - lo)
                severity, grade = model.score(part.column(place))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(severity), pa.array(grade.astype(np.int32)), pa.array(grade >= model.toxic_from)], [*columns, *names])

    kinds = ("double", "int", "boolean")
    schema = docs.select("*", *(F.lit(None).cast(k).alias(n) for k, n in zip(kinds, names))).schema
    return docs.mapInArrow(run, schema)


def label_grade() -> Column:
    """Severity of the labels table: 0 harmless, 1 of low quality though not toxic, 2 toxic."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("toxic") == 0, 1 - F.coalesce("quality", F.lit(1)))


LABEL_GRADES, LABEL_TOXIC = 2, 2
