"""Language identification by interpolated Kneser-Ney character models.

All training texts are counted: every character four-gram, per language, reduced per
task before the one shuffle. Lower orders follow from the four-grams as continuation
counts. Every four-gram is kept, however rare, so a model grows with the different
four-grams of the corpus; estimates and lookup arrays are built from these on the driver
and broadcast.

A model is a set of sorted arrays of packed n-grams, one per order, with the log2
probability under each language. A text is scored at each character by binary search in
the longest order that has the n-gram. The language with the lowest cross-entropy per
character wins; ties go to the first by name. A text is rejected when that entropy
exceeds the language's limit, a quantile over all its correctly identified training texts,
each distinct text (told by its hash) once.

Texts are lower-cased; whatever is not a letter separates. Edge cases: a null text or one
without letters is ``und`` with score 0; rows with a null text or language are not
learned from; without training rows every text is ``und``; repeated rows are scored
each; other columns, whatever their names, are carried along; no rows give no rows.
"""

from __future__ import annotations

import pickle
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

ORDER = 4
#: Calibration: the quantile of the texts' entropies, its accuracy (one rank in so many), and the slack for short texts.
QUANTILE, ACCURACY, SLACK = 0.995, 100_000, 6.0
CHUNK_CHARS = 500_000
UNKNOWN = "und"
_MASKS = [np.uint64((1 << (16 * k)) - 1) for k in range(ORDER + 1)]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The symbol of every code point: itself for letters, 0 else; those beyond 16 bits share one."""
    table = np.zeros(0x110000, np.uint64)
    for point in range(0x110000):
        if chr(point).isalpha():
            table[point] = min(point, 0xFFFF)
    return table


def symbols(text: str) -> np.ndarray:
    """Letters with single zeros between words and around the text; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _letters()[points]
    if not found.any():
        return found[:0]
    found = np.concatenate([[np.uint64(0)], found, [np.uint64(0)]])
    return found[np.concatenate([[True], (found[1:] > 0) | (found[:-1] > 0)])]


def grams(texts: list[np.ndarray]) -> np.ndarray:
    """The packed four-gram that ends at each symbol after a text's first; zeros stand before it."""
    packed = []
    for text in texts:
        padded = np.concatenate([np.zeros(ORDER - 2, np.uint64), text])
        key = padded[ORDER - 1:].copy()
        for back in range(1, ORDER):
            key |= padded[ORDER - 1 - back:len(padded) - back] << np.uint64(16 * back)
        packed.append(key)
    return np.concatenate(packed) if packed else np.zeros(0, np.uint64)


def _counter(batches):
    for batch in batches:
        by_lang: dict[str, list] = {}
        size = 0
        rows = list(zip(batch.column("lang").to_pylist(), batch.column("text")))
        for k, (lang, text) in enumerate(rows):
            found = symbols(text.as_py())
            by_lang.setdefault(lang, []).append(found)
            size += len(found)
            if size >= 8 * CHUNK_CHARS or k == len(rows) - 1:
                for name, texts in by_lang.items():
                    keys, counts = np.unique(grams([t for t in texts if len(t)]), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                         pa.array(counts, pa.int64())], names=["lang", "gram", "n"])
                by_lang, size = {}, 0


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n`` of all four-grams."""
    return rows.select("lang", "text").mapInArrow(_counter, "lang string, gram bigint, n bigint").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))


def _kneser_ney(keys: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """Per order from 1: sorted n-grams with probabilities, sorted contexts with back-off weights."""
    levels = []
    for order in range(ORDER, 0, -1):
        levels.append((order, keys, counts))
        # How many different symbols precede the shorter n-gram.
        keys, counts = np.unique(keys & _MASKS[order - 1], return_counts=True)
    model: list[tuple] = []
    for order, keys, counts in reversed(levels):
        counts = counts.astype(np.float64)
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.75
        contexts, of = np.unique(keys >> np.uint64(16), return_inverse=True)
        total = np.bincount(of, counts)
        kinds = np.bincount(of)
        weight = discount * kinds / total
        if order == 1:
            lower = np.full(len(keys), 1.0 / (len(keys) + 1))
        else:
            shorter, probability = model[-1][0], model[-1][1]
            lower = probability[np.searchsorted(shorter, keys & _MASKS[order - 1])]
        model.append((keys, np.maximum(counts - discount, 0) / total[of] + weight[of] * lower, contexts, weight))
    return model


class Model:
    """All languages: per order a sorted array of n-grams and log2 probabilities by language."""

    def __init__(self, langs: list[str], models: list[list[tuple]]):
        self.langs = langs
        self.limits = np.full(len(langs), np.inf)
        self.orders, below = [], None
        for k in range(ORDER):
            keys = np.unique(np.concatenate([m[k][0] for m in models]))
            contexts = np.unique(np.concatenate([m[k][2] for m in models]))
            weights = np.ones((len(contexts), len(langs)))
            probability = np.empty((len(keys), len(langs)))
            for j, m in enumerate(models):
                weights[np.searchsorted(contexts, m[k][2]), j] = m[k][3]
            if k:
                shorter = np.searchsorted(below[0], keys & _MASKS[k])
                lower = below[1][shorter]
            else:
                lower = np.array([[1.0 / (len(m[0][0]) + 1) for m in models]])
            # Unseen in a language: back off from its context.
            probability[:] = weights[np.searchsorted(contexts, keys >> np.uint64(16))] * lower
            for j, m in enumerate(models):
                probability[np.searchsorted(keys, m[k][0]), j] = m[k][1]
            below = (keys, probability)
            self.orders.append((keys, np.log2(probability).astype(np.float32), contexts,
                                np.log2(weights).astype(np.float32)))
        self.unseen = np.array([-np.log2(len(m[0][0]) + 1) for m in models], np.float32)

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """Log2 probabilities of four-grams, by language."""
        found = np.zeros((len(keys), len(self.langs)), np.float32)
        rest = np.arange(len(keys))
        for order in range(ORDER, 0, -1):
            known, logs, contexts, weights = self.orders[order - 1]
            own = keys[rest] & _MASKS[order]
            place = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = known[place] == own
            found[rest[hit]] += logs[place[hit]]
            rest, own = rest[~hit], own[~hit] >> np.uint64(16)
            if not rest.size:
                return found
            place = np.minimum(np.searchsorted(contexts, own), len(contexts) - 1)
            seen = contexts[place] == own
            found[rest[seen]] += weights[place[seen]]
        found[rest] += self.unseen
        return found

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits per character of each text (all with letters) under each language."""
        keys, back = np.unique(grams(texts), return_inverse=True)
        sizes = np.array([len(t) - 1 for t in texts])
        starts = np.cumsum(sizes) - sizes
        logs = self.logs(keys)
        return np.stack([-np.add.reduceat(logs[:, j][back].astype(np.float64), starts) / sizes
                         for j in range(len(self.langs))], axis=1)

    def judge(self, texts: list[str | None]) -> list[tuple]:
        """Per text: language, score, bits per character, rejected."""
        out: list[tuple] = [(UNKNOWN, 0.0, None, True)] * len(texts)
        spelled = [symbols(t) if t else _letters()[:0] for t in texts]
        at = [k for k, s in enumerate(spelled) if len(s)]
        if not at or not self.langs:
            return out
        bits = self.entropies([spelled[k] for k in at])
        for k, row in zip(at, bits):
            size = len(spelled[k]) - 1
            best = int(np.argmin(row))
            # Probability of the language if all were as likely; long texts are not counted in full.
            score = 1.0 / np.exp2((row[best] - row) * min(size, 50)).sum()
            rejected = bool(row[best] > self.limits[best] + SLACK / size)
            out[k] = (self.langs[best], float(score / 2 if rejected else score), float(row[best]), rejected)
        return out


def fitted(rows: DataFrame) -> Model:
    """A model of the rows' ``lang`` and ``text``."""
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    table = gram_counts(rows).toArrow()
    names = np.array(table.column("lang").to_pylist(), object)
    keys = table.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    counts = table.column("n").to_numpy()
    langs, models = sorted(set(names)), []
    for lang in langs:
        own = np.flatnonzero(names == lang)
        own = own[np.argsort(keys[own])]
        models.append(_kneser_ney(keys[own], counts[own]))
    if not langs:
        model = Model.__new__(Model)
        model.langs, model.orders, model.limits = [], [], np.zeros(0)
        return model
    model = Model(langs, models)
    judged = _judged(rows.select("lang", "text", F.xxhash64("text").alias("page")), model).where("lang_pred = lang")
    # Copies are dropped per task before the shuffle, and the quantiles merge partial sketches.
    limits = judged.groupBy("lang", "page").agg(F.first("bits").alias("bits")).groupBy("lang").agg(
        F.percentile_approx("bits", QUANTILE, ACCURACY).alias("limit"))
    for r in limits.collect():
        model.limits[langs.index(r["lang"])] = r["limit"]
    return model


def _judged(rows: DataFrame, model: Model) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kept = [c for c in rows.columns if c != "text"]

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            out, run_of, size = [], [], 0
            for text in batch.column("text"):
                run_of.append(text.as_py())
                size += len(run_of[-1] or "")
                if size >= CHUNK_CHARS:
                    out += model.judge(run_of)
                    run_of, size = [], 0
            out += model.judge(run_of)
            columns = list(zip(*out)) if out else [()] * 4
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[*kept, "lang_pred", "score", "bits", "rejected"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, bits double, rejected boolean")


def identified(docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang",
               carried: list[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its ``carried`` columns), ``lang_pred``, ``score``,
    ``bits`` per character and ``rejected``; learned from the rows where ``training`` holds."""
    model = fitted(docs.where(training).select(
        F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in carried or docs.columns]).alias("row"),
                       F.col(f"`{text_col}`").alias("text"))
    return _judged(rows, model)
