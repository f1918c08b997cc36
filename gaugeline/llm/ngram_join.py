"""Similarity join of documents on word n-grams, by prefixes of rare n-grams.

Two documents link when the Jaccard similarity of their n-gram sets is at least
``percent`` in a hundred. If they link, they share an n-gram among the first
``n - ceil(t n) + 1`` of each, in any global order; rare n-grams come first here.

1. Every text's n-grams go to buckets by hash, packed per document. A bucket counts in
   how many documents each n-gram occurs and sends back those that occur repeatedly.
   All others are alone and come first in the order, so they are never sent.
2. Per document the repeated n-grams are ordered by (documents, hash). A document whose
   prefix holds only n-grams of its own links with nothing and is done. Documents with
   equal sets are collapsed into the one with the smallest id.
3. Prefix n-grams are joined. Pairs pass the length filter and the positional filter,
   and each remaining pair is verified once, after the suffix filter: a bound on the
   overlap from the numbers of n-grams in 32 parts of the hash space.
4. A large group of near copies would give every pair. Connectivity is all that is
   asked, so first each document is compared with the smallest document of each of its
   prefix n-grams, then again with the smallest outside that one's component; last come
   all pairs that are still in different components. No link between components is lost.

Edge cases: null and empty texts have no n-grams and link with nothing; rows that repeat
a document give one row; rows with one id and different texts share a component; rows
with a null id link with nothing and have a null component; other columns are left out;
no rows give no rows.
"""

from __future__ import annotations

import hashlib
import operator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .components import components
from .shingles import WORDS, shingle_sets

PERCENT = 80
#: Text bytes whose n-grams share a bucket.
BUCKET_BYTES, LEAST_BUCKETS = 16_000_000, 64
CHUNK_CHARS = 1_000_000
PARTS = 32

#: Bytes of a hash that are sent; its bucket tells the upper bits.
SENT_BYTES = 6

_SENT = pa.schema([("bucket", pa.int32()), ("doc", pa.int64()), ("n", pa.int32()), ("home", pa.bool_()),
                   ("grams", pa.binary())])
_SENT_DDL = "bucket int, doc bigint, n int, home boolean, grams binary"


def _packed(rows: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Consecutive rows of bytes as one binary value per stop."""
    width = rows.shape[1] if rows.ndim == 2 else 1
    offsets = np.concatenate([[0], stops]).astype(np.int64) * width
    data = np.ascontiguousarray(rows).view(np.uint8).ravel()
    return pa.Array.from_buffers(pa.large_binary(), len(stops), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _texts(batches, columns):
    """Runs of rows with bounded text, as (columns..., texts)."""
    for batch in batches:
        start, size, texts = 0, 0, batch.column("text").to_pylist()
        for k, text in enumerate(texts):
            size += len(text or "")
            if size >= CHUNK_CHARS or k == len(texts) - 1:
                yield [batch.column(c).slice(start, k + 1 - start) for c in columns], texts[start:k + 1]
                start, size = k + 1, 0


def _sender(buckets: int, words: int):
    def run(batches):
        for (docs,), texts in _texts(batches, ["doc"]):
            sets = shingle_sets(texts, words)
            sizes = np.array([len(s) for s in sets], np.int64)
            grams = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), sizes)
            # The upper bits choose the bucket, so the buckets of a sorted set ascend.
            bucket = ((grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            keys = owner * buckets + bucket  # ascending, as sets are sorted
            rows, starts = np.unique(keys, return_index=True)
            empty = np.flatnonzero(sizes == 0)
            stops = np.concatenate([np.append(starts[1:], len(keys))[:len(rows)], np.full(len(empty), len(keys))])
            owners = np.concatenate([rows // buckets, empty])
            places = np.concatenate([rows % buckets, np.zeros(len(empty), np.int64)])
            home = np.concatenate([[True], owners[1:] != owners[:-1]])
            low = grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT_BYTES]
            yield pa.RecordBatch.from_arrays([
                pa.array(places, pa.int32()), docs.take(pa.array(owners)), pa.array(sizes[owners], pa.int32()),
                pa.array(home), _packed(low, stops)], schema=_SENT)
    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Of each document in a bucket the n-grams that occur in several, with their counts.
    A document without any keeps one row, in the bucket of its first n-gram."""
    blobs = table.column("grams").to_pylist()
    sizes = np.array([len(b) for b in blobs], np.int64) // SENT_BYTES
    grams = np.zeros((int(sizes.sum()), 8), np.uint8)
    grams[:, :SENT_BYTES] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, SENT_BYTES)
    grams = grams.view("<u8").ravel() | np.uint64((table.column("bucket")[0].as_py() & 0xFFFF) << 48)
    del blobs
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    edges = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]))
    runs = np.diff(np.append(edges, len(ordered)))
    counts = np.empty(len(grams), np.uint32)
    counts[order] = np.repeat(runs, runs)
    shared = counts > 1
    out = np.empty(int(shared.sum()), np.dtype([("gram", "<u8"), ("count", "<u4")]))
    out["gram"], out["count"] = grams[shared], counts[shared]
    kept = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[shared], minlength=len(sizes))
    rows = pa.table([table.column("doc"), table.column("n"),
                     _packed(out.view(np.uint8).reshape(-1, 12), np.cumsum(kept))], names=["doc", "n", "grams"])
    return rows.filter(pa.array((kept > 0) | np.asarray(table.column("home"))))


def _required(n: np.ndarray | int, percent: int):
    """Least overlap of a set of size n with a set that links with it."""
    return -(-percent * n // 100)


_SETS_DDL = "doc bigint, n int, prefix int, alone int, digest binary, grams binary, parts array<int>"
_SETS = pa.schema([("doc", pa.int64()), ("n", pa.int32()), ("prefix", pa.int32()), ("alone", pa.int32()),
                   ("digest", pa.binary()), ("grams", pa.binary()), ("parts", pa.list_(pa.int32()))])


def _ordered_sets(percent: int):
    kind = np.dtype([("gram", "<u8"), ("count", "<u4")])

    def run(batches):
        for batch in batches:
            out = []
            for doc, n, blobs in zip(*(batch.column(c).to_pylist() for c in ("doc", "n", "blobs"))):
                found = np.unique(np.frombuffer(b"".join(blobs), kind))
                alone = n - len(found)
                prefix = n - _required(n, percent) + 1 - alone if n else 0
                if prefix <= 0 or not len(found):
                    out.append((doc, n, 0, alone, None, None, None))
                    continue
                grams = found["gram"][np.lexsort((found["gram"], found["count"]))]
                parts = np.bincount((grams & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS)
                # A set with n-grams of its own equals no other.
                name = found["gram"].tobytes() if not alone else b"own %d" % doc
                out.append((doc, n, min(prefix, len(grams)), alone, hashlib.md5(name).digest(),
                            grams.tobytes(), parts.astype(np.int32)))
            columns = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SETS)], schema=_SETS)
    return run


def gram_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document its set size and, where links are possible, its repeated n-grams in
    rare-first order, the length of their prefix, and how many n-grams are its own."""
    rows = docs.select(docs[id_col].cast("bigint").alias("doc"), docs[text_col].alias("text")).where(
        F.col("doc").isNotNull())
    volume = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, volume // BUCKET_BYTES + 1)
    sent = rows.mapInArrow(_sender(buckets, words), _SENT_DDL)
    back = sent.groupBy("bucket").applyInArrow(_repeated, "doc bigint, n int, grams binary")
    per_doc = back.groupBy("doc", "n").agg(
        F.collect_list(F.when(F.octet_length("grams") > 0, F.col("grams"))).alias("blobs"))
    return per_doc.mapInArrow(_ordered_sets(percent), _SETS_DDL)


#: A prefix n-gram of a document, its place in the order, and its place among those that
#: other documents have as well.
TOKEN = ["gram", "doc", "n", "place", "rank"]
#: The same of the other document of a pair.
OTHER = {"doc": "a", "n": "m", "place": "there", "rank": "other_rank"}


def _tokens(batches):
    for batch in batches:
        docs, n, prefix, alone = (np.asarray(batch.column(c)) for c in ("doc", "n", "prefix", "alone"))
        grams = [np.frombuffer(b, "<i8")[:p] for b, p in zip(batch.column("grams").to_pylist(), prefix)]
        if not grams:
            continue
        sizes = np.array([len(g) for g in grams])
        owner = np.repeat(np.arange(len(grams)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(grams)), pa.array(docs[owner]), pa.array(n[owner]),
            pa.array((alone[owner] + place + 1).astype(np.int32)), pa.array((place + 1).astype(np.int32))],
            names=TOKEN)


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """The length and the positional filter. Before a common n-gram only the n-grams that
    are not a document's own can be common, behind it all may be."""
    overlap = (F.least("rank", "other_rank") + F.least(
        F.col("n") - F.col("place"), F.col("m") - F.col("there"))).cast("bigint")
    small, large = F.least("n", "m").cast("bigint"), F.greatest("n", "m").cast("bigint")
    return pairs.where((100 * small >= percent * large)
                       & ((100 + percent) * overlap >= percent * (small + large)))


def _overlapping(pairs: DataFrame, percent: int) -> DataFrame:
    """The suffix filter, on ``parts`` and ``other_parts``."""
    bound = reduce(operator.add, [F.least(F.col("parts")[i], F.col("other_parts")[i]) for i in range(PARTS)])
    return pairs.where((100 + percent) * bound.cast("bigint") >= percent * (F.col("n") + F.col("m")).cast("bigint"))


def _verifier(percent: int):
    def run(batches):
        for batch in batches:
            a, b, n, m = (np.asarray(batch.column(c), np.int64) for c in ("a", "b", "n", "m"))
            parts = [batch.column(c).flatten().to_numpy().reshape(-1, PARTS) for c in ("parts_a", "parts_b")]
            least = -(-percent * (n + m) // (100 + percent))
            near = np.minimum(*parts).sum(axis=1) >= least  # the suffix filter
            grams = [batch.column(c) for c in ("grams_a", "grams_b")]
            links = np.zeros(len(a), bool)
            for k in np.flatnonzero(near):
                left, right = (np.frombuffer(g[k].as_buffer(), "<u8") for g in grams)
                links[k] = len(np.intersect1d(left, right, assume_unique=True)) >= least[k]
            yield pa.RecordBatch.from_arrays([pa.array(a[links]), pa.array(b[links])], names=["a", "b"])
    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (``a``, ``b``) that link. Only sets in some pair are moved."""
    pairs = materialise(pairs, "pairs")
    inside = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    sets = materialise(sets.join(materialise(inside, "paired"), "doc", "left_semi"), "paired-sets")
    side = lambda x, n: sets.select(F.col("doc").alias(x), F.col("n").alias(n), F.col("grams").alias(
        f"grams_{x}"), F.col("parts").alias(f"parts_{x}"))
    return pairs.join(side("a", "n"), "a").join(side("b", "m"), "b").mapInArrow(
        _verifier(percent), "a bigint, b bigint")


def _with_leader(tokens: DataFrame, percent: int) -> DataFrame:
    """Every document with the smallest of those that share a prefix n-gram."""
    lead = tokens.groupBy("gram").agg(
        F.min(F.struct(*TOKEN[1:])).alias("lead"), F.count("*").alias("docs")).where(
        F.col("docs") > 1).select("gram", *[F.col(f"lead.{c}").alias(OTHER[c]) for c in TOKEN[1:]])
    pairs = tokens.join(lead, "gram").where(F.col("doc") != F.col("a"))
    return _possible(pairs, percent).select("a", F.col("doc").alias("b")).distinct()


def _labelled(tokens: DataFrame, links: DataFrame) -> DataFrame:
    """Tokens with components, of n-grams whose documents are in several."""
    labels = components(links)
    named = tokens.join(labels, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    split = named.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        F.col("low") != F.col("high")).select("gram", "low")
    return materialise(named.join(split, "gram"), "split-grams")


def links_between(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (``a``, ``b``) that connect all documents that any links connect."""
    tokens = materialise(sets.mapInArrow(
        _tokens, "gram bigint, doc bigint, n int, place int, rank int"), "prefixes")
    first = _with_leader(tokens, percent)
    links = materialise(verified(first, sets, percent), "links")
    rest = _labelled(tokens, links)
    second = _with_leader(rest.where(F.col("component") != F.col("low")).select(*TOKEN), percent)
    links = materialise(links.unionByName(verified(second, sets, percent)), "links")
    rest = _labelled(rest.select(*TOKEN), links)
    # A large group that shares a passage and nothing else must not give all its pairs.
    rest = materialise(rest.join(sets.select("doc", "parts"), "doc"), "split-grams")
    other = rest.select("gram", F.col("parts").alias("other_parts"), *[F.col(c).alias(name) for c, name in OTHER.items()],
                        F.col("component").alias("beyond"))
    pairs = rest.join(other, "gram").where((F.col("a") < F.col("doc")) & (F.col("beyond") != F.col("component")))
    pairs = _overlapping(_possible(pairs, percent), percent).select("a", F.col("doc").alias("b")).distinct()
    return materialise(links.unionByName(verified(pairs, sets, percent)), "links")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: one row per document."""
    per_doc = materialise(gram_sets(docs, id_col, text_col, words, percent), "gram-sets")
    possible = per_doc.where(F.col("prefix") > 0)
    # Equal sets become one; copies meet only after each task has reduced its own.
    sets = materialise(possible.groupBy("n", "digest").agg(
        F.min_by(F.struct("doc", "prefix", "alone", "grams", "parts"), "doc").alias("one")).select(
        "n", "digest", "one.*"), "distinct-sets")
    copies = possible.select(F.col("doc").alias("b"), "n", "digest").join(
        sets.select(F.col("doc").alias("a"), "n", "digest"), ["n", "digest"]).where(
        F.col("a") != F.col("b")).select("a", "b")
    labels = components(links_between(sets, percent).unionByName(copies))
    found = per_doc.select("doc", "n").join(labels, "doc", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"))

    def sizes(batches):
        for _, texts in _texts(batches, []):
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(s) for s in shingle_sets(texts, words)], pa.int64())], names=["n_shingles"])
    unnamed = docs.where(docs[id_col].isNull()).select(F.col(f"`{text_col}`").alias("text")).mapInArrow(
        sizes, "n_shingles bigint")
    return found.unionByName(unnamed.select(
        F.lit(None).cast("bigint").alias("doc_id"), "n_shingles", F.lit(None).cast("bigint").alias("component_id")))
