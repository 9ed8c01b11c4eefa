"""Language identification: sparse multinomial logistic regression on TF-IDF of
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties, and calibrated by a temperature.

N-grams of one to three characters, in lower case and with all that is no letter as
a blank, are hashed to ``FEATURES`` places. Document frequencies are counted over
all training documents. The classifier is fitted on at most ``sample_rows`` of them,
the first by hash of their text within each language; a fifth of these only sets
the temperature. Every text is then judged whole.

Defined cases: NULL texts, and texts without a letter, are ``und`` with score 0; so
are all if nothing can be learned from. Rows without language are never learned
from; rows without doc_id count as held out. Repeated rows are judged one by one.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.texts import column, forgetful, keep_batches_small, small_batches
from factloom.sources.staging import stage

FEATURES = 1 << 15
SAMPLE_ROWS = 4000
UNDETERMINED = "und"


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of a text's n-grams; none if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.where(letter, codes, np.uint32(32))
    codes = codes[np.concatenate([[True], letter[1:] | letter[:-1]])]  # one blank for several
    h = (codes + np.uint32(1)) * np.uint32(0x9E3779B1)
    two = h[:-1] * np.uint32(31) + h[1:]
    three = two[:-1] * np.uint32(31) + h[2:]
    places = np.concatenate([h, two ^ np.uint32(0x5BD1E995), three])
    places ^= places >> np.uint32(15)
    places *= np.uint32(0x85EBCA6B)
    counts = np.bincount(places >> np.uint32(17), minlength=FEATURES)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # languages x (features + 1); the last is the intercept
    temperature: float

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[at]
        x /= np.sqrt((x * x).sum())
        return self.weights[:, at] @ x + self.weights[:, -1]

    def predict(self, text: str | None) -> tuple[str, float]:
        at, counts = ngram_counts(text)
        if not len(at) or not self.languages:
            return UNDETERMINED, 0.0
        p = _softmax(self.logits(at, counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def remainder():
    """crc32 of doc_id as text, modulo 5; 0 means held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each place occurs, and how many texts there are."""

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in column(batch, "text"):
                seen[ngram_counts(text.as_py())[0]] += 1
                rows += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, FEATURES)), pa.array(np.append(seen[at], rows))], names=["place", "n"])

    got = texts.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(FEATURES + 1, np.int64)  # bounded by the number of places
    counts[got.column("place").to_numpy()] = got.column("n").to_numpy()
    return counts[:-1], int(counts[-1])


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, epochs: int = 3) -> Model:
    """Learns from text and lang of the documents that are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != 0)).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    with small_batches(docs.sparkSession):
        return _fitted(labelled, sample_rows, epochs)


def _fitted(labelled: DataFrame, sample_rows: int, epochs: int) -> Model:
    frequency, total = document_frequencies(labelled)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    # The same number of each language at most, chosen by hash of the text.
    mark = F.xxhash64("text")
    chosen = stage(labelled.select("lang", mark.alias("mark")).distinct(), "language-marks").df
    # Hashes are even, so the first of a language lie under a bound; only some of it is ranked.
    sizes = stage(chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "language-sizes")
    chosen = chosen.join(sizes.side(), "lang").where((F.col("mark") / 2.0**64 + 0.5) * F.col("size") <= 4.0 * sample_rows)
    chosen = chosen.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("mark")))
    chosen = chosen.where(F.col("r") <= sample_rows)
    chosen = stage(chosen.orderBy("r", "lang").limit(sample_rows).select("lang", "mark"), "language-sample").df
    sample = labelled.withColumn("mark", mark).join(F.broadcast(chosen), ["lang", "mark"])  # at most sample_rows

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_counts(text.as_py()) for text in column(batch, "text")]
            yield pa.RecordBatch.from_arrays([
                column(batch, "lang"), column(batch, "mark"),
                pa.array([at.astype(np.int32) for at, _ in found], pa.list_(pa.int32())),
                pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32()))], names=["lang", "mark", "at", "n"])

    got = sample.select("lang", "mark", "text").mapInArrow(run, "lang string, mark long, at array<int>, n array<int>")
    # Copies of one text count once, so that the bound holds.
    got = got.dropDuplicates(["lang", "mark"]).orderBy("mark", "lang").toArrow()
    languages = sorted(set(got.column("lang").to_pylist()))
    rows = [(languages.index(lang), at.values.to_numpy(), np.asarray(n.values.to_numpy(), np.float64))
            for lang, at, n in zip(got.column("lang").to_pylist(), got.column("at"), got.column("n")) if len(at.values)]
    if not rows:
        return Model([], idf, np.zeros((0, FEATURES + 1)), 1.0)
    fit_rows = [row for i, row in enumerate(rows) if i % 5] or rows
    rest = [row for i, row in enumerate(rows) if not i % 5]
    model = Model(languages, idf, ftrl(fit_rows, idf, len(languages), epochs), 1.0)
    return Model(languages, idf, model.weights, temperature(model, rest))


def ftrl(rows: list[tuple], idf: np.ndarray, classes: int, epochs: int, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.5) -> np.ndarray:
    """Follow-the-regularised-leader, proximal, with one learning rate per weight."""
    z, n = np.zeros((classes, FEATURES + 1)), np.zeros((classes, FEATURES + 1))

    def weights(at):
        zs = z[:, at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2)
        return np.where(np.abs(zs) <= l1, 0.0, w)

    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            label, at, counts = rows[i]
            x = (1 + np.log(counts)) * idf[at]
            x = np.append(x / np.sqrt((x * x).sum()), 1.0)
            at = np.append(at, FEATURES)
            w = weights(at)
            error = _softmax(w @ x)
            error[label] -= 1
            g = error[:, None] * x[None, :]
            old = n[:, at]
            z[:, at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / alpha * w
            n[:, at] = old + g * g
    return weights(np.arange(FEATURES + 1))


def temperature(model: Model, rows: list[tuple]) -> float:
    """The temperature with the least log loss on rows the weights were not fitted on."""
    if not rows:
        return 1.0
    logits = np.array([model.logits(at, counts) for _, at, counts in rows])
    labels = np.array([label for label, _, _ in rows])
    candidates = np.exp(np.linspace(np.log(0.05), np.log(20), 121))

    def loss(t: float) -> float:
        p = _softmax(logits / t)[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    return float(min(candidates, key=loss))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; reads doc_id and text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x FEATURES weights

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found = [own.predict(text.as_py()) for text in column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "held_out"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    keep_batches_small(docs.sparkSession)
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder() == 0).alias("held_out"),
                          F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents whose language is known well enough, columns as they were."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found = (own.predict(text.as_py()) for text in column(batch, "text").cast(pa.string()))
            yield batch.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in found], pa.bool_()))

    keep_batches_small(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
