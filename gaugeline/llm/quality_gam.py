"""Document quality by a generalised additive model with pairwise interactions.

Features of a text are binned; every feature has a lookup table over its bins, and the
strongest pairs of features have one over pairs of bins. The tables are learned by cyclic
boosting: round after round each feature in turn gets a tree of at most three leaves, fit
to the residual of all the others; pairs follow in the same way. A score is a sum of
lookups, done for a whole batch at once.

The fit uses a bounded sample of labelled rows (``sample``, chosen by hash); its features
are computed by Spark and only these numbers come to the driver.

Edge cases: null and empty texts are scored as texts without words; labels for missing
documents, null labels and repeated labels of one document (the smallest counts) are
handled; without usable labels every score is the share of good labels, or 0.5; repeated
rows are scored each; other columns, whatever their names, are carried along.
"""

from __future__ import annotations

import operator
import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE, BINS, PAIR_BINS, PAIRS = 20_000, 64, 12, 6
ROUNDS, RATE, MIN_LEAF = 250, 0.1, 8
CUT = 0.7

FEATURES = ["log_words", "word_length", "upper", "digits", "spaces", "symbols", "marks", "exclaimed",
            "non_ascii", "distinct_words", "distinct_triples", "repeated_next", "top_word", "words_per_line",
            "repeated_lines"]


def _share(counts: np.ndarray, characters: bytes) -> float:
    return float(counts[list(characters)].sum())


def features(text: str | None) -> tuple:
    text = text or ""
    words = text.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size = max(1, len(text))
    seen = Counter(words)
    lines = [line for line in text.split("\n") if line]
    triples = len(set(zip(words, words[1:], words[2:]))) if n > 2 else 1
    return (
        np.log1p(n), len(text) / max(1, n), counts[65:91].sum() / size, counts[48:58].sum() / size,
        _share(counts, b" \t\n\r") / size, _share(counts, b"#*$%&|<>@^~=+_\\/{}[]") / size,
        _share(counts, b".,;:'\"()-") / size, _share(counts, b"!?") / size, counts[128:].sum() / size,
        len(seen) / max(1, n), triples / max(1, n - 2), sum(map(operator.eq, words, words[1:])) / max(1, n - 1),
        max(seen.values(), default=0) / max(1, n), n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)))


def _tree(gain_of: np.ndarray, weight: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Leaf values per bin of the best tree with up to three leaves over ordered bins."""
    def best(low: int, high: int):
        g, h, n = (np.cumsum(x[low:high]) for x in (gain_of, weight, count))
        if len(g) < 2:
            return 0.0, None
        score = g ** 2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1)
        score = np.where((n >= MIN_LEAF) & (n[-1] - n >= MIN_LEAF), score, 0)[:-1]
        k = int(np.argmax(score))
        return float(score[k]), low + k + 1
    size = len(gain_of)
    cuts, gain = [], best(0, size)
    if gain[1] is not None and gain[0] > 0:
        cuts = [gain[1]]
        second = max(best(0, cuts[0]), best(cuts[0], size), key=lambda x: x[0])
        if second[1] is not None and second[0] > 0:
            cuts = sorted([cuts[0], second[1]])
    values = np.zeros(size)
    for low, high in zip([0, *cuts], [*cuts, size]):
        values[low:high] = gain_of[low:high].sum() / (weight[low:high].sum() + 1)
    return values


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes of a table: its gain and the value in each cell."""
    def corners(x):
        c = x.cumsum(0).cumsum(1)
        return np.stack([c, c[-1:, :] - c, c[:, -1:] - c, c[-1, -1] - c[-1:, :] - c[:, -1:] + c])
    gs, hs = corners(g), corners(h)
    score = (gs ** 2 / (hs + 1)).sum(0) - g.sum() ** 2 / (h.sum() + 1)
    score = score[:-1, :-1]
    if not score.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(np.argmax(score)), score.shape)
    values = np.empty_like(g)
    leaf = gs[:, i, j] / (hs[:, i, j] + 1)
    values[:i + 1, :j + 1], values[i + 1:, :j + 1], values[:i + 1, j + 1:], values[i + 1:, j + 1:] = leaf
    return float(score[i, j]), values


class Gam:
    """Lookup tables per feature and per pair of features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.share = float(y.mean()) if len(y) else 0.5
        self.edges, self.tables, self.pairs = [], [], []
        if len(y) < 2 * MIN_LEAF or y.min() == y.max():
            return
        self.start = float(np.log(self.share / (1 - self.share)))
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(column, quantiles)) for column in x.T]
        bins = self._bins(x)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        total = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-total))
                size = len(table)
                step = RATE * _tree(np.bincount(bins[j], y - p, size), np.bincount(bins[j], p * (1 - p), size),
                                    np.bincount(bins[j], minlength=size))
                table += step
                total += step[bins[j]]
        coarse = [b * PAIR_BINS // len(t) for b, t in zip(bins, self.tables)]

        def sums(i, j):
            p = 1 / (1 + np.exp(-total))
            cell = coarse[i] * PAIR_BINS + coarse[j]
            return [np.bincount(cell, v, PAIR_BINS ** 2).reshape(PAIR_BINS, -1) for v in (y - p, p * (1 - p))]
        names = [(i, j) for i in range(len(bins)) for j in range(i)]
        best = sorted(names, key=lambda ij: -_quadrants(*sums(*ij))[0])[:PAIRS]
        self.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for i, j in best]
        for _ in range(ROUNDS // 4):
            for i, j, table in self.pairs:
                step = RATE * _quadrants(*sums(i, j))[1]
                table += step
                total += step[coarse[i], coarse[j]]

    def _bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, column, "right") for e, column in zip(self.edges, x.T)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.tables:
            return np.full(len(x), self.share)
        bins = self._bins(x)
        total = np.full(len(x), self.start)
        for b, table in zip(bins, self.tables):
            total += table[b]
        for i, j, table in self.pairs:
            total += table[bins[i] * PAIR_BINS // len(self.tables[i]), bins[j] * PAIR_BINS // len(self.tables[j])]
        return 1 / (1 + np.exp(-total))


def _measured(batches):
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(rows, pa.list_(pa.float64()))],
                                         names=["quality", "x"])


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE) -> Gam:
    """A model of labelled documents; ``labels`` has the id and ``quality`` (0 or 1)."""
    chosen = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.min("quality").cast("int").alias("quality")).orderBy(
        F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "id")
    found = rows.select("quality", "text").mapInArrow(_measured, "quality int, x array<double>").toArrow()
    x = np.array(found.column("x").to_pylist()).reshape(-1, len(FEATURES))
    y = found.column("quality").to_numpy().astype(float)
    # A fixed order, so that the fit does not depend on how tasks were scheduled.
    order = np.lexsort([*x.T, y])
    return Gam(x[order], y[order])


def scored(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id",
           text_col: str = "text", carried: list[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its ``carried`` columns), ``score`` and ``predicted``;
    ``training`` says of ``labels`` which rows may be learned from."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(
        fitted(docs, labels.where(training), id_col, text_col)))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in carried or docs.columns]).alias("row"),
                       F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column("text")]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.scores(x))], names=["row", "score"])
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double").withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))
