"""The n-gram join against all pairs compared one by one."""

import re

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import components, ngram_join

SPACE = "[\x20\x09-\x0d]+"


def shingles(text):
    words = [w for w in re.split(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """``{doc: (n, component)}`` by comparing every pair."""
    sets = [(doc, shingles(text)) for doc, text in rows]
    component = {doc: doc for doc, _ in sets}

    def find(x):
        while component[x] != x:
            x = component[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                if 100 * len(x & y) >= 80 * len(x | y):
                    low, high = sorted((find(a), find(b)))
                    component[high] = low
    return {doc: (len(s), find(doc)) for doc, s in sets}


def joined(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked(df).collect()}


def variants(count):
    """Groups of texts at various distances: chains, copies, shared passages, tiny texts."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(count):
        words = list(base)
        for j in range(k % 7):
            words[(k * 13 + j * 17) % 60] = f"x{k}_{j}"
        rows.append((k, " ".join(words)))
        rows.append((1000 + k, " ".join(base[:45]) + " " + " ".join(f"own{k}_{j}" for j in range(10 + k % 9))))
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "one two"), (2004, "One\tTWO"), (2005, "one two three"),
             (2006, "a b c d e"), (2007, "A b  c\nd e"), (2008, "é É c d e f"), (2009, "long " * 30_000)]
    return rows


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_all_pairs(frame):
    rows = variants(40)
    assert joined(frame(rows)) == brute(rows)


def test_documents_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert joined(docs) == brute(rows)


def test_chain_through_a_bridge(frame):
    """The ends of a chain don't link, yet share its component."""
    base = [f"w{i}" for i in range(100)]
    rows = [(9 - k, " ".join(base[:100 - 6 * k] + [f"z{j}" for j in range(6 * k)])) for k in range(6)]
    found = joined(frame(rows))
    assert found == brute(rows)
    assert {component for _, component in found.values()} == {4}


def test_odd_rows(spark, frame):
    assert joined(frame([])) == {}
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (None, None)]
    found = ngram_join.linked(frame(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in found) == [
        (0, 0, 0), (0, 2, 0), (1, 2, 1)]
    clash = frame(variants(6)).selectExpr("*", "1 AS n", "2 AS grams", "3 AS doc", "4 AS bucket")
    assert joined(clash) == brute(variants(6))


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(50, 40), (40, 45)], "a bigint, b bigint")
    found = {r["doc"]: r["component"] for r in components.components(links).collect()}
    assert found == {**{k: 0 for k in range(31)}, 40: 40, 45: 40, 50: 40}
    empty = components.components(links.where(F.lit(False)))
    assert empty.count() == 0
