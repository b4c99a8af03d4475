"""Operator 8: quality rules by gradient-boosted trees over document statistics.

Statistics of a whole text are computed in one narrow pass of Arrow batches, and the same
pass scores them: the trees are flattened into node arrays (feature, threshold, children,
value) that walk all rows of a batch at once.  The trees are fitted with logistic loss on
a sample of labelled rows of at most ``MAX_TRAIN_ROWS`` distinct texts, the smallest by a
hash; statistics and verdicts cover every row.  Monotonic constraints: more symbols,
repeated lines, repeated words or capitals never raise a score.

A NULL or empty text has no words and fails the base rule.  Equal rows get equal
verdicts.  Without labels of both classes the trees are empty and only the base rule
rejects.  Extra columns are kept by :func:`keep` and ignored elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import words

MAX_TRAIN_ROWS = 20_000
SYMBOLS = "#*$%&|<>"
_SYMBOL_BYTES = SYMBOLS.encode()
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_PUNCT = b"!\"'(),-./:;?@[\\]^_`{}~+="

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "punctuation",
            "digits", "distinct"]
#: +1: the score may only rise with the feature; -1: only fall; 0: free.
MONOTONE = np.array([0, 0, -1, -1, -1, -1, 0, 0, 0])


def repeat_words(items: list[bytes], distinct: dict[bytes, int]) -> int:
    """Words in 3-word windows that the text has twice or more, each word once."""
    n = len(items)
    if n < 4:
        return 0
    ids = np.fromiter(map(distinct.__getitem__, items), np.int64, n)
    size = len(distinct)
    pair = ids[:-1] * size + ids[1:]
    if size > 2_000_000:  # three ids of this size no longer fit in 63 bits
        _, pair = np.unique(pair, return_inverse=True)
    key = pair[:-1] * size + ids[2:]
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    again = times[at] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """Base statistics and features of one whole text."""
    items = words(text)
    n = len(items)
    if not n:
        return [0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0], [0.0] * len(FEATURES)
    raw = text.encode("utf-8")
    chars = len(text) - (len(raw) - sum(map(len, items)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOL_BYTES))
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    dup = len(lines) - len(set(lines))
    distinct = {w: i for i, w in enumerate(dict.fromkeys(items))}
    repeats = repeat_words(items, distinct)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    punct = len(raw) - len(raw.translate(None, _PUNCT))
    digits = len(raw) - len(raw.translate(None, _DIGITS))
    features = [np.log1p(n), chars / n, symbols / n, dup / len(lines), repeats / n, upper / chars,
                punct / n, digits / chars, len(distinct) / n]
    return [n, chars, symbols, dup, repeats], features


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])


@dataclass
class Forest:
    """Trees as node arrays; a leaf points at itself."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of features."""
        total, row = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2,
              bins: int = 32, l2: float = 2.0, monotone: np.ndarray = MONOTONE) -> Forest:
    """Boosted regression trees on the gradients of the logistic loss, by histograms."""
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    share = float(y.mean()) if len(y) else 1.0
    if len(y) == 0 or share in (0.0, 1.0):
        return Forest(*(np.zeros(0, t) for t in (int, float, int, int, float)), np.zeros(0, int), 0, 20.0)
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    total = np.full(len(y), start)

    def leaf_value(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + l2), low, high))

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        at = len(nodes)
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        nodes.append([0, np.inf, at, at, rate * leaf_value(sum_g, sum_h, low, high)])
        if level == depth or len(rows) < 20:
            return at
        best = (1e-6, None)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            n = len(e) + 1
            left_g = np.cumsum(np.bincount(binned[rows, j], g[rows], n))[:-1]
            left_h = np.cumsum(np.bincount(binned[rows, j], h[rows], n))[:-1]
            left_n = np.cumsum(np.bincount(binned[rows, j], minlength=n))[:-1]
            right_g, right_h = sum_g - left_g, sum_h - left_h
            v_left = np.clip(-left_g / (left_h + l2), low, high)
            v_right = np.clip(-right_g / (right_h + l2), low, high)
            gain = left_g ** 2 / (left_h + l2) + right_g ** 2 / (right_h + l2) - sum_g ** 2 / (sum_h + l2)
            ok = (left_n >= 5) & (len(rows) - left_n >= 5) & (monotone[j] * (v_right - v_left) >= 0)
            gain = np.where(ok, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], j, k, v_left[k], v_right[k])
        if best[1] is None:
            return at
        _, j, k, v_left, v_right = best
        goes = binned[rows, j] <= k
        middle = (v_left + v_right) / 2
        left_low, left_high, right_low, right_high = low, high, low, high
        if monotone[j] < 0:
            left_low, right_high = middle, middle
        elif monotone[j] > 0:
            left_high, right_low = middle, middle
        nodes[at][0], nodes[at][1] = j, float(edges[j][k])
        nodes[at][2] = grow(rows[goes], g, h, level + 1, left_low, left_high)
        nodes[at][3] = grow(rows[~goes], g, h, level + 1, right_low, right_high)
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        first = len(nodes)
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -4.0, 4.0))
        tree = Forest(*[np.array([n[i] for n in nodes]) for i in range(5)], np.array([first]), depth, 0.0)
        at = np.full(len(y), first)
        for _ in range(depth):
            at = np.where(x[np.arange(len(y)), tree.feature[at]] <= tree.threshold[at],
                          tree.left[at], tree.right[at])
        total = total + tree.value[at]
    return Forest(*[np.array([n[i] for n in nodes]) for i in range(5)], np.array(roots), depth, start)


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(text, quality) of at most ``max_rows`` distinct labelled texts, the smallest by hash."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    joined = (docs.select("doc_id", "text").where(F.col("text").isNotNull())
              .withColumn("h", F.xxhash64("doc_id", "text")).join(marks, "doc_id"))
    chosen = joined.select("h").distinct().orderBy("h").limit(max_rows).agg(F.max("h").alias("cut"))
    cut = chosen.first()["cut"]
    return joined.where(F.col("h") <= F.lit(cut).cast("long")).dropDuplicates(["h"]).select("text", "quality")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Forest:
    """Trees for documents of ``docs`` (doc_id, text) labelled in ``labels`` (doc_id, quality)."""
    def run(batches):
        for batch in batches:
            texts, quality = (batch.column(c).to_pylist() for c in ("text", "quality"))
            rows = [statistics(t)[1] for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())),
                                              pa.array(quality, pa.float64())], ["x", "y"])

    sample = training_sample(docs, labels, max_rows).mapInArrow(run, "x array<double>, y double")
    rows = sample.toArrow().to_pydict()
    x = np.array(rows["x"], float).reshape(-1, len(FEATURES))
    y = np.array(rows["y"], float)
    order = np.lexsort((*x.T, y))  # the sample's order must not change the trees
    return fit_trees(x[order], (y[order] > 0).astype(float))


def verdicts(texts: list, forest: Forest, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found = [statistics(t) for t in texts]
    base = np.array([f[0] for f in found], np.int64).reshape(-1, len(BASE))
    score = forest.score(np.array([f[1] for f in found], float).reshape(-1, len(FEATURES)))
    failed = base_failed(base)
    return base, failed, ~failed & (score >= threshold), score


def score(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """doc_id, base statistics, base_failed, kept, score."""
    def run(batches):
        for batch in batches:
            base, failed, kept, value = verdicts(batch.column("text").to_pylist(), forest, threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(base[:, i]) for i in range(len(BASE))),
                 pa.array(failed), pa.array(kept), pa.array(value)],
                ["doc_id", *BASE, "base_failed", "kept", "score"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE)
    return docs.select("doc_id", "text").mapInArrow(
        run, schema + ", base_failed boolean, kept boolean, score double")


def keep(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that the verdict keeps."""
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(verdicts(batch.column("text").to_pylist(), forest, threshold)[2]))

    return docs.mapInArrow(run, docs.schema)
