"""Operator 9: language by sparse multinomial logistic regression on TF-IDF character n-grams.

n-grams of one to three characters (letters lower-cased, anything else a space) of the
whole text are hashed into ``BUCKETS`` counts.  Document frequencies come from every
training document by one aggregation of at most ``BUCKETS`` rows per task.  The weights
are trained by follow-the-regularised-leader with elastic-net penalties on at most
``MAX_TRAIN_DOCS`` labelled documents, dealt evenly over the languages, the smallest by a
hash; a fifth of them is left out to fit the temperature that calibrates the scores.

A NULL text or one without a letter is ``und`` with score 0, and so is every text if no
labelled document can be learned from.  Equal texts get equal results; extra columns are
ignored by :func:`predict` and kept by :func:`keep`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
MAX_TRAIN_DOCS = 3000
UNKNOWN = "und"
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter, else a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that the text has, ascending, and their counts."""
    chars = _letters()[np.frombuffer(text.lower().encode("utf-32-le"), "<u4")].astype(np.uint64)
    counts, key = np.zeros(BUCKETS, np.int64), None
    for n, factor in enumerate(_FACTORS):
        if len(chars) <= n:
            break
        key = chars if key is None else (key[:-1] << np.uint64(21)) + chars[n:]
        bucket = (key * factor) >> np.uint64(64 - BUCKET_BITS)
        counts += np.bincount(bucket.view(np.int64), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used, counts[used]


def held_out(column: str = "doc_id", modulus: int = 4, remainder: int = 2):
    """Of the contract's folds: whether the id is in the one that is never learned from."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus == remainder


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float

    def vector(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        value = (1 + np.log(counts)) * self.idf[used]
        return value / max(float(np.sqrt((value * value).sum())), 1e-12)

    def logits(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(used, counts) @ self.weights[used] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        z = self.logits(*ngrams(text)) / self.temperature
        p = np.exp(z - z.max())
        best = int(np.argmax(p))
        return self.languages[best], float(p[best] / p.sum())


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Over all of ``docs``: in how many texts each bucket is, and the number of texts."""
    def run(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total[ngrams(text)[0]] += 1
                n += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))],
                                         ["bucket", "n"])

    found = (docs.select("text").mapInArrow(run, "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_pydict())
    df, n = np.zeros(BUCKETS, np.int64), 0
    for bucket, count in zip(found["bucket"], found["n"]):
        if bucket < 0:
            n = count
        else:
            df[bucket] = count
    return df, n


def training_sample(docs: DataFrame, max_docs: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Counts of at most ``max_docs`` labelled documents, as many of each language."""
    marked = docs.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    languages = [r["lang"] for r in docs.select("lang").distinct().limit(max_docs).collect()]
    if not languages:
        return []
    each = max(1, max_docs // len(languages))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = (marked.select("lang", "h").withColumn("rank", rank).where(F.col("rank") <= each)
              .select("lang", "h").distinct())

    def run(batches):
        for batch in batches:
            found = [ngrams(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("lang"), pa.array([u for u, _ in found], pa.list_(pa.int64())),
                 pa.array([c for _, c in found], pa.list_(pa.int64()))], ["h", "lang", "used", "counts"])

    rows = (marked.join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"])
            .select("h", "lang", "text").mapInArrow(run, "h long, lang string, used array<long>, counts array<long>")
            .toArrow())
    out = []
    for batch in rows.to_batches():
        for i in range(batch.num_rows):
            out.append((batch["h"][i].as_py(), batch["lang"][i].as_py(), batch["used"][i].values.to_numpy(),
                        batch["counts"][i].values.to_numpy()))
    return [r[1:] for r in sorted(out, key=lambda r: (r[0], r[1]))]


def train(sample: list, idf: np.ndarray, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.1) -> Model:
    """Follow-the-regularised-leader over the sample, then the temperature."""
    languages = sorted({r[0] for r in sample})
    k = len(languages)
    model = Model(languages, idf, np.zeros((BUCKETS, k)), np.zeros(k), 1.0)
    if k == 0:
        return model
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))  # the last row is the bias

    def weights(at):
        value = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, value)

    spare = sample[::5] if len(sample) >= 50 else sample
    learned = [r for i, r in enumerate(sample) if i % 5] if len(sample) >= 50 else sample
    for _ in range(epochs):
        for lang, used, counts in learned:
            at, x = np.append(used, BUCKETS), np.append(model.vector(used, counts), 1.0)
            w = weights(at)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[languages.index(lang)] -= 1
            g = x[:, None] * p[None, :]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    final = weights(np.arange(BUCKETS + 1))
    model.weights, model.bias = final[:-1], final[-1]
    logits = np.array([model.logits(used, counts) for _, used, counts in spare])
    truth = np.array([languages.index(r[0]) for r in spare])

    def loss(t):
        s = logits / t
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), truth]).mean())

    model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    return model


def fit(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> Model:
    """A model from ``docs`` (doc_id, text, lang); rows without text or lang are passed over."""
    usable = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    df, n = document_frequencies(usable)
    return train(training_sample(usable, max_docs), np.log((1 + n) / (1 + df)) + 1)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out (kept from the input), lang_pred, score."""
    def run(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep(docs: DataFrame, model: Model, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at least ``min_score``."""
    def run(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and s >= min_score for lang, s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
