"""Text scores by a Katz backoff model of word pairs.

Counts of words and of pairs (a word after its predecessor, or after the start) are
discounted by Good-Turing; what the discounts free is dealt to the pairs a context was not
seen with, by the words' own probabilities, so that the probabilities after every context
add up to one exactly:

    P(w | h) = d(c(hw)) c(hw) / c(h)   if hw was seen,    alpha(h) P(w)   otherwise
    P(w)     = d(c(w)) c(w) / N        if w was seen,     the mass left   for all unseen words

Texts are cut into chunks of whole documents. A chunk asks for each of its different words
and pairs once: the keys go, packed as arrays, to the partition of the table that holds
them, where the counts of all chunks are added up, and the totals go back to the chunk.
Words get exact numbers on the way, so pairs are told apart exactly. A frequent context is
spread over several partitions and its sums are added up by Spark. Nothing that grows with
the corpus reaches the driver.

Edge cases: null and empty texts are their end token alone; without training texts every
token is unknown and every score 0; repeated rows count and are scored each; if counts of
counts are too few or too uneven for Good-Turing, fewer counts are discounted, in the end
only those of 1 (by 2 n2 / n1, else by half); other columns, whatever their names, are
carried along.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path

CHUNK = 5_000_000       # bytes of text after which a chunk ends (it holds one document at least)
BUCKET = 2_000_000      # tokens of the corpus for each partition of a table
SPREAD = 100_000        # occurrences of a context for each partition it is spread over
DISCOUNTED = 5          # larger counts are taken as they are
START = -1              # the number of the context before a text's first token
_SUMS = [f"s{i}" for i in range(2 * DISCOUNTED + 2)]
_REPLY = "chunk bigint, bucket bigint, kind string, codes binary, a binary, b binary"


def packed(x: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(data: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


# --- discounts ---------------------------------------------------------------------------

def discounts(n: list[int]) -> np.ndarray:
    """Factors for counts 0 to ``DISCOUNTED`` from ``n[r - 1]``, how many have count ``r``
    (up to ``DISCOUNTED + 1``)."""
    out = np.ones(DISCOUNTED + 1)
    n = np.array([0, *n], float)
    for last in range(DISCOUNTED, 1, -1):
        r = np.arange(1, last + 1)
        if (n[1:last + 2] <= 0).any():
            continue
        beyond = (last + 1) * n[last + 1] / n[1]
        factors = ((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond) if beyond < 1 else np.zeros(last)
        if ((factors > 0) & (factors < 1)).all():
            out[1:last + 1] = factors
            return out
    one = 2 * n[2] / n[1] if n[1] else 0.5
    out[1] = one if 0 < one < 1 else 0.5
    return out


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * factors[np.where(counts <= DISCOUNTED, counts, 0)]


class Words:
    """Word probabilities: ``tokens`` and ``types`` of the training texts, mass of unseen words."""

    def __init__(self, tokens: int, types: int, n: list[int]):
        self.tokens, self.types, self.factors = tokens, types, discounts(n)
        freed = sum((1 - self.factors[r]) * r * n[r - 1] for r in range(1, DISCOUNTED + 1))
        # Without a count to discount, one more token is set aside for unseen words.
        self.total = tokens if freed > 0 else tokens + 1
        self.unseen = freed / tokens if freed > 0 else 1 / (tokens + 1)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.factors) / self.total, self.unseen)


def context_weights(sums: np.ndarray, words: Words, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``alpha`` and denominator of contexts, from whole sums over their seen successors:
    occurrences, how many occur 1, 2, ... times; occurrences in the corpus of the frequent
    ones, and how many of the rest are words with count 1, 2, ..."""
    r = np.arange(1, DISCOUNTED + 1)
    total = sums[:, 0].astype(float)
    freed = (sums[:, 1:DISCOUNTED + 1] * r * (1 - factors[1:])).sum(1)
    below = (sums[:, DISCOUNTED + 1] + (sums[:, DISCOUNTED + 2:] * r * words.factors[1:]).sum(1)) / words.total
    # Without a count to discount, one more occurrence is set aside for unseen successors.
    denominator = np.where(freed > 0, total, total + 1)
    return np.where(freed > 0, freed, 1) / denominator / (1 - below), denominator


# --- chunks ------------------------------------------------------------------------------

def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Documents as numbers of the chunk's words; 0 is the end of a text."""
    parts, size, number = [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(pc.fill_null(batch.column("text"), "")).to_numpy().astype(np.int64))
        start = 0
        while start < len(batch):
            done = ends[start - 1] if start else 0
            stop = min(len(batch), int(np.searchsorted(ends, done + limit - size, "right")) + 1)
            parts.append(_tokens(batch.slice(start, stop - start)))
            size += int(ends[stop - 1] - done)
            start = stop
            if size >= limit:
                yield _chunk(parts, number)
                parts, size, number = [], 0, number + 1
    if parts:
        yield _chunk(parts, number)


def _tokens(batch: pa.RecordBatch) -> tuple:
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column("text"), "")))
    words = lists.flatten()
    real = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    return (batch.column("row"), batch.column("learned").to_numpy(zero_copy_only=False).astype(bool),
            np.diff(before[ends]) + 1, words.filter(real))


def _chunk(parts: list[tuple], number: int) -> pa.RecordBatch:
    rows, learned, sizes, words = zip(*parts)
    rows, learned, sizes = pa.concat_arrays(rows), np.concatenate(learned), np.concatenate(sizes)
    words = pa.concat_arrays(words).dictionary_encode()
    codes = np.zeros(sizes.sum(), np.int32)
    inside = np.ones(len(codes), bool)
    inside[np.cumsum(sizes) - 1] = False
    codes[inside] = words.indices.to_numpy() + 1
    names = pa.concat_arrays([pa.array([""]), words.dictionary])
    seen = np.bincount(codes[np.repeat(learned, sizes)], minlength=len(names))
    return pa.RecordBatch.from_arrays(
        [pa.array([(TaskContext.get().partitionId() << 32) + number]), pa.array([len(codes)]),
         _one(rows), pa.array([packed(sizes.astype(np.int64))]),
         pa.array([learned.tobytes()]), pa.array([packed(codes)]), _one(names),
         pa.array([packed(seen.astype(np.int64))])],
        names=["chunk", "tokens", "rows", "sizes", "learned", "codes", "words", "seen"])


def _one(values: pa.Array) -> pa.Array:
    """All values as a single list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _chunk_table(docs: DataFrame, training: Column, text_col: str, carried: list[str] | None,
                 limit: int) -> DataFrame:
    """The chunks, written in buckets by number, so that replies join them where they lie."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in carried or docs.columns]).alias("row"),
                       F.coalesce(training, F.lit(False)).alias("learned"), F.col(f"`{text_col}`").alias("text"))
    name = f"chunks_{uuid.uuid4().hex}"
    rows.mapInArrow(
        lambda batches: _chunks(batches, limit), f"chunk bigint, tokens bigint, rows array<{rows.schema['row'].dataType.simpleString()}>, "
        "sizes binary, learned binary, codes binary, words array<string>, seen binary",
    ).write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").option(
        "path", scratch_path(spark, "chunks")).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved; the files stay when the name goes
    spark.sql(f"DROP TABLE {name}")
    return table


def _by_kind(df: DataFrame, name: str) -> dict[str, DataFrame]:
    """``df`` written as a table partitioned by ``kind``."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy("kind").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return {kind: table.where(F.col("kind") == kind) for kind in ("table", "reply", "context")}


def _pieces(chunk: int, bucket: np.ndarray, columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    """A chunk's keys cut by bucket; ``codes`` tells which they are."""
    order = np.argsort(bucket, kind="stable")
    numbers, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts, len(order))
    out = {"bucket": pa.array(numbers.astype(np.int64)), "chunk": pa.array(np.full(len(numbers), chunk)),
           "codes": pa.array([packed(order[a:b].astype(np.int32)) for a, b in zip(ends, ends[1:])], pa.binary())}
    for name, x in columns.items():
        if isinstance(x, np.ndarray):
            x = x[order]
            out[name] = pa.array([packed(x[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())
        else:
            out[name] = pa.ListArray.from_arrays(ends.astype(np.int32), x.take(pa.array(order)))
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _rows(kind: str, rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist([{"kind": kind, **r} for r in rows], schema)


def _spread(counts: np.ndarray) -> list[int]:
    """Sum, number, and how many there are of each small count."""
    few = np.bincount(counts[counts <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)
    return [int(counts.sum()), int((counts > 0).sum()), *map(int, few[1:])]


def _totals(table: DataFrame) -> list[int]:
    """``_spread`` of a whole table, added up by Spark."""
    rows = table.select(F.posexplode("spread")).groupBy("pos").agg(F.sum("col").alias("n")).orderBy("pos").collect()
    return [int(r["n"]) for r in rows] or [0] * (DISCOUNTED + 3)


# --- words -------------------------------------------------------------------------------

_WORD_SCHEMA = pa.schema([("kind", pa.string()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("codes", pa.binary()),
                          ("a", pa.binary()), ("b", pa.binary()), ("words", pa.list_(pa.string())),
                          ("spread", pa.list_(pa.int64()))])


def _word_tables(chunks: DataFrame, buckets: int) -> dict[str, DataFrame]:
    """``table``: words with their counts; ``reply``: numbers (``a``) and counts (``b``) of a chunk's words."""
    def split(batches):
        for batch in batches:
            for i in range(len(batch)):
                words = batch.column("words")[i].values
                bucket = np.array([xxhash.xxh3_64_intdigest(w) % buckets for w in words.to_pylist()], np.int64)
                yield _pieces(batch.column("chunk")[i].as_py(), bucket,
                              {"words": words, "seen": unpacked(batch.column("seen")[i].as_py())})

    def merge(key, rows):
        rows = rows.sort_by("chunk").combine_chunks()
        bucket = key[0].as_py()
        words = rows.column("words").combine_chunks().flatten().dictionary_encode()
        at = words.indices.to_numpy()
        seen = [unpacked(x) for x in rows.column("seen").to_pylist()]
        counts = np.bincount(at, np.concatenate(seen), len(words.dictionary)).astype(np.int64)
        out, start = [], 0
        for chunk, codes, part in zip(rows.column("chunk").to_pylist(), rows.column("codes").to_pylist(), seen):
            these = at[start:start + len(part)]
            start += len(part)
            out.append({"bucket": bucket, "chunk": chunk, "codes": codes,
                        "a": packed((bucket << 32) + these.astype(np.int64)), "b": packed(counts[these])})
        return pa.concat_tables([
            _rows("reply", out, _WORD_SCHEMA),
            _rows("table", [{"bucket": bucket, "b": packed(counts), "words": words.dictionary.to_pylist(),
                             "spread": _spread(counts)}], _WORD_SCHEMA)])
    return _by_kind(chunks.select("chunk", "words", "seen").mapInArrow(
        split, "bucket bigint, chunk bigint, codes binary, words array<string>, seen binary").groupBy(
        "bucket").applyInArrow(merge, "kind string, bucket bigint, chunk bigint, codes binary, a binary, b binary, "
                                      "words array<string>, spread array<bigint>"), "words")


# --- pairs -------------------------------------------------------------------------------

class _Pairs:
    """The different pairs of a chunk, their places at its tokens, and where their counts are kept."""

    def __init__(self, row: dict, buckets: int, spread: int):
        self.sizes, self.codes = unpacked(row["sizes"]), unpacked(row["codes"], np.int32).astype(np.int64)
        self.learned = np.frombuffer(row["learned"], bool)
        words = [r for r in row["replies"] if r["kind"] == "word"]
        width = sum(len(unpacked(r["codes"], np.int32)) for r in words)
        # The last place is the start of a text; it occurs as often as the end, place 0.
        self.ids, self.counts = np.full(width + 1, START), np.zeros(width + 1, np.int64)
        for r in words:
            at = unpacked(r["codes"], np.int32)
            self.ids[at], self.counts[at] = unpacked(r["a"]), unpacked(r["b"])
        self.counts[width] = self.counts[0]
        before = np.concatenate([[width], self.codes[:-1]])
        before[np.cumsum(self.sizes)[:-1]] = width
        keys, self.at = np.unique(before * width + self.codes, return_inverse=True)
        self.before, self.word = keys // width, keys % width
        # A pair with a word that training texts lack was not seen there.
        self.asked = np.flatnonzero((self.counts[self.before] > 0) & (self.counts[self.word] > 0))
        context, word = self.ids[self.before[self.asked]], self.ids[self.word[self.asked]]
        parts = (1 + self.counts[self.before[self.asked]] // spread).astype(np.uint64)
        self.bucket = (_mixed(_mixed(context.view(np.uint64)) + _mixed(word.view(np.uint64)) % parts)
                       % np.uint64(buckets)).astype(np.int64)
        self.context, self.follower = context, word

    def seen(self) -> np.ndarray:
        """How often the pairs asked for occur in the chunk's training texts."""
        trained = self.at[np.repeat(self.learned, self.sizes)]
        return np.bincount(trained, minlength=len(self.word))[self.asked].astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(8)


_PAIR_SCHEMA = pa.schema([("kind", pa.string()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("codes", pa.binary()),
                          ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()),
                          ("spread", pa.list_(pa.int64()))])


def _pair_tables(chunks: DataFrame, replies: DataFrame, buckets: int, spread: int) -> dict[str, DataFrame]:
    """``table``: context, word and count of the pairs seen; ``reply``: counts (``a``) of a
    chunk's pairs; ``context``: numbers and sums of the contexts."""
    def split(batches):
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                pairs = _Pairs(row, buckets, spread)
                yield _pieces(row["chunk"], pairs.bucket, {
                    "context": pairs.context, "word": pairs.follower, "seen": pairs.seen(),
                    "below": pairs.counts[pairs.word[pairs.asked]]})

    def merge(key, rows):
        rows = rows.sort_by("chunk")
        bucket = key[0].as_py()
        context, word, seen, below = ([unpacked(x) for x in rows.column(c).to_pylist()]
                                      for c in ("context", "word", "seen", "below"))
        sizes = [len(x) for x in seen]
        contexts, c = np.unique(np.concatenate(context), return_inverse=True)
        words, w = np.unique(np.concatenate(word), return_inverse=True)
        keys, first, at = np.unique(c * len(words) + w, return_index=True, return_inverse=True)
        counts = np.bincount(at, np.concatenate(seen), len(keys)).astype(np.int64)
        below = np.concatenate(below)[first]
        out = [{"bucket": bucket, "chunk": chunk, "codes": codes, "a": packed(counts[these])} for chunk, codes, these in
               zip(rows.column("chunk").to_pylist(), rows.column("codes").to_pylist(),
                   np.split(at, np.cumsum(sizes)[:-1]))]
        trained = counts > 0
        keys, counts, below = keys[trained], counts[trained], below[trained]
        c = keys // len(words)

        def sums(which: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(c[which], None if weight is None else weight[which], len(contexts))
        every, r = np.ones(len(c), bool), range(1, DISCOUNTED + 1)
        table = np.stack([sums(every, counts), *(sums(counts == i) for i in r), sums(below > DISCOUNTED, below),
                          *(sums(below == i) for i in r)], 1).astype(np.int64)
        used = table[:, 0] > 0
        return pa.concat_tables([
            _rows("reply", out, _PAIR_SCHEMA),
            _rows("context", [{"bucket": bucket, "a": packed(contexts[used]), "b": packed(table[used].ravel())}],
                  _PAIR_SCHEMA),
            _rows("table", [{"bucket": bucket, "a": packed(contexts[c]), "b": packed(words[keys % len(words)]),
                             "c": packed(counts), "spread": _spread(counts)}], _PAIR_SCHEMA)])
    return _by_kind(chunks.select("chunk", "sizes", "learned", "codes").join(replies, "chunk").mapInArrow(
        split, "bucket bigint, chunk bigint, codes binary, context binary, word binary, seen binary, below binary"
    ).groupBy("bucket").applyInArrow(
        merge, "kind string, bucket bigint, chunk bigint, codes binary, a binary, b binary, c binary, "
               "spread array<bigint>"), "pairs")


def _weights(contexts: DataFrame, asked: DataFrame, words: Words, factors: np.ndarray) -> tuple[DataFrame, tuple]:
    """Replies with ``alpha`` (``a``) and denominator (``b``) of a chunk's words as contexts, and
    those of the start of a text."""
    def opened(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                sums = unpacked(b).reshape(-1, len(_SUMS))
                yield pa.RecordBatch.from_arrays([pa.array(unpacked(a)), *map(pa.array, sums.T)], names=["id", *_SUMS])

    def weigh(batches):
        for batch in batches:
            sums = np.stack([batch.column(c).to_numpy() for c in _SUMS], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, context_weights(sums, words, factors))],
                names=["id", "alpha", "denominator"])
    weights = contexts.select("a", "b").mapInArrow(
        opened, "id bigint, " + ", ".join(f"{c} bigint" for c in _SUMS)).groupBy("id").agg(
        *[F.sum(c).alias(c) for c in _SUMS]).mapInArrow(weigh, "id bigint, alpha double, denominator double")

    def reply(key, found, pieces):
        ids = found.column("id").to_numpy()
        order = np.argsort(ids)
        table = np.stack([found.column(c).to_numpy()[order] for c in ("alpha", "denominator")])
        # A word that no training text goes on after has no weights.
        ids, table = np.append(ids[order], 1 << 62), np.concatenate([table, [[1.0], [0.0]]], 1)
        out = []
        for chunk, codes, a in zip(*(pieces.column(c).to_pylist() for c in ("chunk", "codes", "a"))):
            wanted = unpacked(a)
            at = np.searchsorted(ids, wanted)
            alpha, denominator = table[:, np.where(ids[at] == wanted, at, len(ids) - 1)]
            out.append({"chunk": chunk, "bucket": key[0].as_py(), "kind": "weight", "codes": codes,
                        "a": packed(alpha), "b": packed(denominator)})
        return pa.Table.from_pylist(out, pa.schema([
            ("chunk", pa.int64()), ("bucket", pa.int64()), ("kind", pa.string()),
            *[(c, pa.binary()) for c in ("codes", "a", "b")]]))
    start = weights.where(F.col("id") == START).collect()
    bucket = F.shiftright("id", 32).alias("bucket")
    replies = weights.where(F.col("id") != START).withColumn("bucket", bucket).groupBy("bucket").cogroup(
        asked.select("bucket", "chunk", "codes", "a").groupBy("bucket")).applyInArrow(reply, _REPLY)
    return replies, (start[0]["alpha"], start[0]["denominator"]) if start else (1.0, 0.0)


# --- scores ------------------------------------------------------------------------------

def _scores(row: dict, buckets: int, spread: int, words: Words, factors: np.ndarray, start: tuple
            ) -> tuple[np.ndarray, ...]:
    """Tokens, known tokens, base and model log probabilities of a chunk's documents."""
    pairs = _Pairs(row, buckets, spread)
    counts = np.zeros(len(pairs.word), np.int64)
    alpha, denominator = np.ones(len(pairs.ids)), np.zeros(len(pairs.ids))
    alpha[-1], denominator[-1] = start
    for r in row["replies"]:
        at = unpacked(r["codes"], np.int32)
        if r["kind"] == "pair":
            counts[pairs.asked[at]] = unpacked(r["a"])
        elif r["kind"] == "weight":
            alpha[at], denominator[at] = unpacked(r["a"], float), unpacked(r["b"], float)
    # Seen pairs by their counts, all others by backing off to the word.
    seen = counts > 0
    backed_off = alpha[pairs.before] * words.probability(pairs.counts[pairs.word])
    log = np.log10(np.where(seen, discounted(counts, factors) / np.where(seen, denominator[pairs.before], 1),
                            backed_off))
    base = np.log10((pairs.counts + 1) / (words.tokens + words.types + 1))
    firsts = np.cumsum(pairs.sizes) - pairs.sizes
    return (pairs.sizes, np.add.reduceat((pairs.counts[pairs.codes] > 0).astype(np.int64), firsts),
            np.add.reduceat(base[pairs.codes], firsts), np.add.reduceat(log[pairs.at], firsts))


def _replies(parts: list[DataFrame]) -> DataFrame:
    """All replies to a chunk in one row; their size is bounded by the chunk's."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("chunk").agg(F.collect_list(F.struct("kind", "codes", "a", "b")).alias("replies"))


def scored(docs: DataFrame, training: Column, text_col: str = "text", carried: list[str] | None = None,
           chunk: int = CHUNK, bucket: int = BUCKET, spread: int = SPREAD) -> DataFrame:
    """``row`` (the input row, or its ``carried`` columns), ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (words counted, plus one) and ``score`` of every document;
    ``training`` says which rows may be learned from; the sizes bound what a task holds."""
    chunks = _chunk_table(docs, training, text_col, carried, chunk)
    tokens = chunks.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    buckets = 1 + tokens // bucket
    of_words = _word_tables(chunks, buckets)
    total, types, *n = _totals(of_words["table"])
    words = Words(total, types, n)
    columns = ["chunk", "bucket", "kind", "codes", "a", "b"]
    known = of_words["reply"].withColumn("kind", F.lit("word")).select(columns)
    of_pairs = _pair_tables(chunks, _replies([known]), buckets, spread)
    factors = discounts(_totals(of_pairs["table"])[2:])
    weights, start = _weights(of_pairs["context"], of_words["reply"], words, factors)
    found = of_pairs["reply"].withColumn("kind", F.lit("pair")).select(columns)
    rows = chunks.select("chunk", "rows", "sizes", "learned", "codes").join(
        _replies([known, found, weights]), "chunk")

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                row = one.drop_columns(["rows"]).to_pylist()[0]
                sizes, n_known, base, score = _scores(row, buckets, spread, words, factors, start)
                yield pa.RecordBatch.from_arrays(
                    [one.column("rows").flatten(), *map(pa.array, (sizes, n_known, base, score))],
                    names=["row", "n_tokens", "n_known", "base_score", "score"])
    kind = chunks.schema["rows"].dataType.elementType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, n_tokens bigint, n_known bigint, base_score double, score double") \
        .withColumn("train_tokens", F.lit(words.tokens).cast("bigint"))
