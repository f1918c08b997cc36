"""Whitening, zone-map clustering and Katz scores against brute force, and on odd rows."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import katz, whitening, zone_clusters
from gaugeline.llm.oracle import ORACLE
from gaugeline.llm.queries import QUERIES
from gaugeline.llm.spectra import Spectra

NAN, INF = float("nan"), float("inf")


def vectors_of(sf_dir):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet' ORDER BY vec_id").fetchall()
    return [r[0] for r in rows], np.array([r[1] for r in rows], float)


# --- spectra -----------------------------------------------------------------------------

@pytest.mark.parametrize("rows, dim, kind", [
    (1, 4, "normal"), (3, 5, "normal"), (200, 6, "whole"), (400, 20, "normal"), (300, 12, "flat"), (90, 1, "normal"),
    (120, 7, "copies"), (50, 9, "equal")])
def test_rank_one_updates_give_the_eigenpairs(rows, dim, kind):
    random = np.random.default_rng(rows)
    x = {"normal": lambda: random.normal(size=(rows, dim)),
         "whole": lambda: random.integers(-2, 3, (rows, dim)).astype(float),
         "flat": lambda: random.integers(0, 2, (rows, dim)) * (np.arange(dim) < 5.0),
         "copies": lambda: np.repeat(random.normal(size=(rows // 30, dim)), 30, 0),
         "equal": lambda: np.full((rows, dim), 3.0)}[kind]()
    lanes = Spectra.empty(4, dim)
    for i in range(0, rows, 4):
        lanes.add(x[i:i + 4])
    whole = lanes.merged()
    centred = x - x.mean(0)
    scatter = centred.T @ centred
    basis = whole.vectors[0]
    assert whole.count[0] == rows and np.allclose(whole.mean[0], x.mean(0))
    assert np.allclose(basis @ basis.T, np.eye(dim), atol=1e-12)
    assert np.allclose(basis.T * whole.values[0] @ basis, scatter, atol=1e-9 * max(1, np.abs(scatter).max()))


def test_spectra_of_unequal_lanes_and_empty_ones_combine():
    random = np.random.default_rng(1)
    x = random.normal(size=(37, 5))
    parts = []
    for part in (x[:30], x[30:37], x[:0]):
        one = Spectra.empty(1, 5)
        for row in part:
            one.add(row[None])
        parts.append(one)
    whole = Spectra.stacked(parts).merged()
    centred = x - x.mean(0)
    assert np.allclose(whole.mean[0], x.mean(0))
    assert np.allclose(whole.values[0], np.linalg.eigvalsh(centred.T @ centred))


# --- whitening ---------------------------------------------------------------------------

def check_whitening(found, ids, x):
    """``found`` rows by id and component against numpy over the distinct vectors ``x``."""
    x = np.floor(64 * x).astype(np.int64) + whitening.OFFSET
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    by_id = defaultdict(dict)
    for r in found:
        by_id[r["vec_id"]][r["component"]] = r
    assert set(by_id) == set(ids)
    signs = {}
    for vec_id, row in zip(ids, x):
        rows = by_id[vec_id]
        assert sorted(rows) == list(range(1, min(16, x.shape[1]) + 1))
        for c, r in rows.items():
            assert r["n"] == n and r["deviation"] == sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums))
            value = float((row - sums / n) @ axes[:, c - 1] / math.sqrt(values[c - 1]))
            sign = signs.setdefault(c, 1 if value * r["whitened"] >= 0 else -1) if abs(value) > 1e-3 else signs.get(c)
            assert abs(r["whitened"] - (sign or 1) * value) < 1e-6 or abs(value) <= 1e-3
            assert abs(r["explained"] / (values[c - 1] / values.sum()) - 1) < 1e-9
            assert r["identity_error"] < 1e-9


def test_whitening_equals_numpy(spark, sf_dir):
    ids, x = vectors_of(sf_dir)
    check_whitening(QUERIES["op11_whitening"](spark, sf_dir).collect(), ids, x)


def test_whitening_combines_many_partitions(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    ids, x = vectors_of(sf_dir)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<float>")
    real = whitening.materialise
    spread = lambda df, name: real(df.repartition(7) if name == "vectors" else df, name)
    monkeypatch.setattr(whitening, "materialise", spread)
    check_whitening(whitening.whitened(docs, carried=["vec_id"]).select("row.vec_id", "*").collect(), ids, x)


ODD = [(None, [0.5, 1.0, 2.0]), (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [NAN, 1.0, 1.0]), (5, [INF, 1.0, 1.0]),
       (6, [0.0, 1.0, -3.0]), (6, [0.0, 1.0, -3.0]), (7, [1.0, 1.0]), (8, [-2.0, 0.25, 1.0]), (9, [3e38, 1.0, 1.0]),
       (10, [1.5, -1.0, 0.125]), (11, [0.5, 0.5, 0.5]), (12, [2.0, 2.0])]


def odd_vectors(spark):
    frame = spark.createDataFrame(ODD, "vec_id bigint, embedding array<float>")
    return frame.withColumns({c: F.lit(7) for c in ("row", "dim", "code", "n", "cluster", "distance", "place")})


def test_whitening_of_odd_vectors(spark):
    rows = whitening.whitened(odd_vectors(spark)).select("row.vec_id", "row.row", "*").collect()
    assert {r[1] for r in rows} == {7}
    three = [r for r in rows if r["n"] == 5]
    assert Counter(r["vec_id"] for r in three) == {None: 3, 6: 6, 8: 3, 10: 3, 11: 3}
    two = [r for r in rows if r["n"] == 2]
    assert {r["vec_id"] for r in two} == {7, 12}
    # Two vectors vary along one component only.
    assert all(abs(abs(r["whitened"]) - 1) < 1e-9 if r["component"] == 1 else r["whitened"] == r["explained"] == 0
               for r in two)
    assert max(r["identity_error"] for r in rows) < 1e-9


def test_whitening_of_equal_vectors_and_of_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    rows = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows] == [
        (1, 0, 0.0, 0.0, 0.0)] * 4
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0


def test_large_deviations_stay_exact(spark):
    rows = whitening.whitened(spark.createDataFrame(
        [(i, [7.5e6 * i, -2e7]) for i in range(5)], "vec_id bigint, embedding array<double>")).collect()
    x = [[7_500_000 * i * 64, -20_000_000 * 64] for i in range(5)]
    exact = [sum((5 * a - sum(s)) ** 2 for a, s in zip(row, zip(*x))) for row in x]
    assert max(exact) >= 2 ** 63 > min(exact)
    for r in rows:
        far = exact[r["row"]["vec_id"]]
        assert (r["deviation"] if far < 2 ** 63 else int(r["deviation_exact"])) == far


# --- clustering --------------------------------------------------------------------------

def test_clusters_equal_their_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    done = connection.execute(ORACLE["op12_zone_clusters"])
    names = [c[0] for c in done.description]
    rows = QUERIES["op12_zone_clusters"](spark, sf_dir).select(*names).collect()
    assert Counter(map(tuple, rows)) == Counter(done.fetchall())


def brute_clusters(rows, dims, k, rounds):
    import hashlib
    kept = [(i, [math.floor(64 * float(v)) for v in x]) for i, x in rows]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "~", x) for i, x in kept)
    centroids = [x for _, x in order[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in kept:
            groups[near(x)[1]].append(x)
        for n, xs in groups.items():
            centroids[n] = [sum(v) // len(xs) for v in zip(*xs)]
    return Counter((i, near(x)[1], near(x)[0]) for i, x in kept)


def test_clusters_of_odd_vectors(spark):
    usable = [r for r in ODD if r[0] not in (1, 2, 3, 4, 5, 7, 9, 12)]
    for k in (2, 4, 16):
        rows = zone_clusters.clustered(odd_vectors(spark), dims=3, k=k).select("row.vec_id", "cluster", "distance")
        assert Counter(map(tuple, rows.collect())) == brute_clusters(usable, 3, k, 3)
    assert zone_clusters.clustered(odd_vectors(spark)).count() == 0
    assert zone_clusters.clustered(odd_vectors(spark).limit(0), dims=3).count() == 0


def test_large_components_are_compared_exactly(spark):
    rows = [(i, [1.9e6 * (-1) ** i, 1000.0 * i, 0.5 * i]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = zone_clusters.clustered(frame, dims=3, k=5).select("row.vec_id", "cluster", "distance").collect()
    assert Counter(map(tuple, found)) == brute_clusters(rows, 3, 5, 3)


def test_zone_maps_leave_out_no_nearest_centroid():
    random = np.random.default_rng(5)
    left = 0
    for _ in range(200):
        centroids = random.integers(-40, 40, (16, 8))
        x = centroids[random.integers(16)] + random.integers(-4, 5, (30, 8))
        among = zone_clusters.candidates(x.min(0), x.max(0), centroids)
        at, distance = zone_clusters.nearest(x, centroids)
        near, same = zone_clusters.nearest(x, centroids[among])
        assert (among[near] == at).all() and (same == distance).all()
        left += 16 - len(among)
    assert left > 200 * 8


def test_the_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        places = zone_clusters.hilbert(cells, bits)
        assert len(set(places.tolist())) == len(cells)
        steps = np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(1)
        assert (steps == 1).all()


# --- Katz scores -------------------------------------------------------------------------

def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [""]


class BruteKatz:
    """The model from its definition, word by word."""

    def __init__(self, texts):
        self.words, self.pairs, self.follows = Counter(), Counter(), defaultdict(Counter)
        for tokens in map(split, texts):
            self.words.update(tokens)
            for h, w in zip([None, *tokens], tokens):
                self.pairs[h, w] += 1
                self.follows[h][w] += 1
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.d1, self.d2 = (katz.discounts([sum(c == r for c in counts.values()) for r in range(1, 7)])
                            for counts in (self.words, self.pairs))
        self.unseen = 1 - sum(self.d(self.d1, c) * c for c in self.words.values()) / max(self.n, 1)
        self.total = self.n
        if self.unseen < 1e-12:
            self.total, self.unseen = self.n + 1, 1 / (self.n + 1)

    @staticmethod
    def d(factors, c):
        return factors[c] if c <= 5 else 1.0

    def word(self, w):
        c = self.words[w]
        return self.d(self.d1, c) * c / self.total if c else self.unseen

    def pair(self, h, w):
        seen = self.follows.get(h)
        if not seen:
            return self.word(w)
        total = sum(seen.values())
        kept = sum(self.d(self.d2, c) * c for c in seen.values())
        if total - kept < 1e-12:
            total += 1
        if w in seen:
            return self.d(self.d2, seen[w]) * seen[w] / total
        return (1 - kept / total) / (1 - sum(self.word(x) for x in seen)) * self.word(w)

    def score(self, text):
        tokens = split(text)
        return sum(math.log10(self.pair(h, w)) for h, w in zip([None, *tokens], tokens))

    def base(self, text):
        return sum(math.log10((self.words[w] + 1) / (self.n + self.v + 1)) for w in split(text))


def held_out(doc_id, folds=7, rest=2):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == rest


def check_katz(found, docs):
    model = BruteKatz([t for i, t in docs if not held_out(i)])
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(t)
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in docs)
    expected = Counter()
    for i, t in docs:
        tokens = split(t)
        expected[i, len(tokens), sum(w in model.words for w in tokens), model.n] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found) == expected
    for r in found:
        assert any(math.isclose(r["score"], model.score(t), rel_tol=1e-9, abs_tol=1e-9)
                   and math.isclose(r["base_score"], model.base(t), rel_tol=1e-9, abs_tol=1e-9)
                   for t in texts[r["doc_id"]])
    return model


def test_katz_equals_the_definition(spark, sf_dir):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    found = QUERIES["op13_katz"](spark, sf_dir).collect()
    check_katz(found, docs)
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in found)
    unseen = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_katz_over_many_chunks_and_partitions(spark, sf_dir):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    fold = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    found = katz.scored(frame, fold, carried=["doc_id"], chunk=20_000, bucket=10_000, spread=20)
    check_katz(found.select("row.doc_id", "*").collect(), docs)


def test_katz_probabilities_add_up_to_one():
    texts = ["a b a b c", "a b a d", "b a a a c", "", "a b e f g", "a b a b a b"]
    model = BruteKatz(texts)
    for h in [None, "a", "b", "c", "unknown"]:
        unseen = model.pair(h, "never seen")
        assert math.isclose(sum(model.pair(h, w) for w in model.words) + unseen, 1)


def test_discounts_fall_back_step_by_step():
    good = katz.discounts([1000, 300, 150, 90, 60, 45])
    assert ((good[1:] > 0) & (good[1:] < 1)).all() and good[0] == 1
    few = katz.discounts([100, 30, 15, 0, 0, 0])
    assert 0 < few[1] < 1 and 0 < few[2] < 1 and (few[3:] == 1).all()
    assert katz.discounts([4, 1, 0, 0, 0, 0])[1] == 0.5
    assert katz.discounts([0, 0, 0, 0, 0, 0])[1] == 0.5


KATZ_ODD = [(None, None), (1, ""), (2, "x" * 50_000), (2, "x" * 50_000), (3, "word " * 30_000), (4, " \n\t "),
            (5, "É é \x1c ÀA"), (6, "Word word word"), (7, "a"), (8, "b a"), (8, None), (9, "word x")]


def test_katz_on_odd_texts(spark):
    frame = spark.createDataFrame(KATZ_ODD, "doc_id bigint, text string").withColumns(
        {c: F.lit(7) for c in ("row", "chunk", "codes", "words", "score", "kind", "learned")})
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2
    found = katz.scored(frame, fold).select("row.doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    check_katz(found.collect(), KATZ_ODD)
    none = katz.scored(frame, F.lit(False)).collect()
    assert {(r["score"], r["base_score"], r["n_known"], r["train_tokens"]) for r in none} == {(0.0, 0.0, 0, 0)}
    assert katz.scored(frame.limit(0), fold).count() == 0
