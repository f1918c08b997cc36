"""Benchmark decontamination by suffix arrays over the training texts.

Every task sorts the word suffixes of its shards of documents and looks up every
benchmark suffix by binary search. A shard's suffix array leaves out the suffixes
that cannot match: a word foreign to the benchmark ends a run, and runs shorter than
the shortest window hold none. Suffixes are sorted to the depth of a window, which
makes the occurrences of a window one range of the array; matches are then extended
word by word to the longest.

A window is ``window`` consecutive words of a benchmark item, or a whole shorter
item. Words are ``[0-9a-z]`` and all non-ASCII characters, with A-Z lowered.

The benchmark is processed in blocks of at most ``block_words`` words, so what is
broadcast at once is bounded; each block passes over the documents in one stage and
adds its hits to what the blocks before found. Nothing is shuffled.

Edge cases: null and empty texts have no words and no hits; a null benchmark text is
an item without words; equal items are reported each; equal document rows are judged
each; other columns, whatever their names, are carried along; an empty benchmark hits
nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW, BLOCK_WORDS = 13, 1_000_000
#: A document is contaminated when its hits make up this share of its words: 1 in 20.
SHARE = 20
#: Bytes of text whose suffixes are sorted together; a longer text is its own shard.
SHARD_BYTES = 4_000_000

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
               for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Block:
    """Suffixes of some benchmark items, as ids of their own vocabulary (from 1)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        item_words = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words],
                               np.int64) for _, words in items]
        self.window = window
        self.shortest = min((min(window, len(w)) for w in item_words if len(w)), default=0)
        low, high, of, lengths, at = [], [], [], [], []
        for k, words in enumerate(item_words):
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                key = np.zeros(window, ">u4")
                key[:size] = words[i:i + size]
                low.append(key)
                top = np.full(window, 0xFFFFFFFF, ">u4")
                top[:size] = key[:size]
                high.append(top)
                of.append(k)
                lengths.append(size)
                at.append(i)
        self.low, self.high = _keys(low, window), _keys(high, window)
        self.of, self.lengths, self.at = (np.array(x, np.int64) for x in (of, lengths, at))
        self.words = np.concatenate([*item_words, np.zeros(1, np.int64)])
        self.first = np.cumsum([0, *map(len, item_words)])


def _keys(rows, window: int) -> np.ndarray:
    """Rows of word ids as fixed-length strings that sort in word order."""
    matrix = np.ascontiguousarray(np.array(rows, ">u4").reshape(-1, window))
    return matrix.view(f"V{4 * window}").ravel()


def _ordered(keys: np.ndarray) -> np.ndarray:
    return keys.view(f"S{keys.dtype.itemsize}")


def search(block: Block, texts: list[list[bytes]]) -> list[tuple[np.ndarray, list[str], list[tuple]]]:
    """Per document of a shard: the hit words (sorted), the items found, and the longest
    matches as (document word, item, item word, length)."""
    nothing = (np.zeros(0, np.int64), [], [])
    out = [nothing] * len(texts)
    if not block.shortest:
        return out
    get = block.vocabulary.get
    # One foreign word after each document keeps matches inside it.
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    words = np.zeros(int(ends[-1]) if len(texts) else 0, np.int64)
    for start, text in zip(starts, texts):
        words[start:start + len(text)] = [get(w, 0) for w in text]
    known = words > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    begin, stop = edges[::2], edges[1::2]
    long = stop - begin >= block.shortest
    begin, stop = begin[long], stop[long] - block.shortest + 1
    if not begin.size:
        return out
    sizes = stop - begin
    suffixes = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    padded = np.concatenate([words, np.zeros(block.window, np.int64)])
    # The ids up to a break: what follows it belongs to another run.
    grid = padded[suffixes[:, None] + np.arange(block.window)]
    grid[np.cumsum(grid == 0, axis=1) > 0] = 0
    keys = _ordered(_keys(grid, block.window))
    order = np.argsort(keys, kind="stable")
    array, keys = suffixes[order], keys[order]
    left = np.searchsorted(keys, _ordered(block.low), "left")
    right = np.searchsorted(keys, _ordered(block.high), "right")
    found = np.maximum(right - left, 0)
    if not found.any():
        return out
    query = np.repeat(np.arange(len(found)), found)
    place = array[np.repeat(left - np.cumsum(found) + found, found) + np.arange(int(found.sum()))]
    size = block.lengths[query]
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, place, 1)
    np.add.at(mark, place + size, -1)
    hits = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    # Longest matches: start where the word before differs, extend while words agree.
    at = block.first[block.of[query]] + block.at[query]
    previous = np.where(block.at[query] > 0, block.words[at - 1], -1)
    first = np.where(place > 0, words[place - 1], 0) != previous
    place, at, size, item = place[first], at[first], size[first].copy(), block.of[query[first]]
    limit = block.first[item + 1]
    growing = np.arange(len(place))
    while growing.size:
        behind = at[growing] + size[growing]
        same = (behind < limit[growing]) & (
            padded[place[growing] + size[growing]] == block.words[behind])
        growing = growing[same]
        size[growing] += 1
    document = np.searchsorted(ends, hits, "right")
    matched = np.searchsorted(ends, place, "right")
    spans: dict[int, list] = {}
    for k in np.lexsort((at, place)):
        d = int(matched[k])
        spans.setdefault(d, []).append((int(place[k] - starts[d]), block.ids[item[k]],
                                        int(at[k] - block.first[item[k]]), int(size[k])))
    for d, longest in spans.items():
        own = hits[np.searchsorted(document, d, "left"):np.searchsorted(document, d, "right")] - starts[d]
        out[d] = (own, sorted({name for _, name, _, _ in longest}), longest)
    return out


_FOUND = "struct<n_words:bigint,hits:binary,items:array<string>,matches:array<struct<" \
         "word:bigint,item:string,item_word:bigint,length:bigint>>>"
_FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("hits", pa.binary()), ("items", pa.list_(pa.string())),
    ("matches", pa.list_(pa.struct([("word", pa.int64()), ("item", pa.string()),
                                    ("item_word", pa.int64()), ("length", pa.int64())])))])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int,
            block_words: int) -> Iterator[Block]:
    """Blocks in item order; the items pass through the driver a partition at a time."""
    items, size = [], 0
    rows = benchmark.select(benchmark[item_col].cast("string"), benchmark[text_col]).toLocalIterator()
    for name, text in rows:
        words = words_of(text)
        items.append((name or "", words))
        size += len(words)
        if size >= block_words:
            yield Block(items, window)
            items, size = [], 0
    if items:
        yield Block(items, window)


def marked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text",
           window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``row`` (the input row) and ``found``: n_words, n_hit, n_items, items_sha256,
    items, matches (the longest, with their places) and contaminated."""
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        F.col(f"`{text_col}`").alias("text"), F.lit(None).cast(_FOUND).alias("found"))
    blocks = list(_blocks(benchmark, item_col, item_text_col, window, block_words)) or [Block([], window)]
    for block in blocks:
        shared = spark.sparkContext.broadcast(pickle.dumps(block))
        rows = rows.mapInArrow(_searcher(shared), rows.schema)
    counted = rows.withColumn("found", F.struct(
        "found.n_words", (F.octet_length("found.hits") / 8).cast("long").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        "found.items", "found.matches"))
    return counted.select("row", F.struct("found.*", (
        (F.col("found.n_hit") > 0) & (SHARE * F.col("found.n_hit") >= F.col("found.n_words"))
    ).alias("contaminated")).alias("found"))


def _searcher(shared):
    def run(batches):
        block = pickle.loads(shared.value)
        for batch in batches:
            texts, before = batch.column("text"), batch.column("found").to_pylist()
            found, shard, size = [], [], 0
            for text in texts:
                words = words_of(text.as_py())
                shard.append(words)
                size += sum(map(len, words)) + len(words)
                if size >= SHARD_BYTES:
                    found += zip(search(block, shard), map(len, shard))
                    shard, size = [], 0
            found += zip(search(block, shard), map(len, shard))
            rows = [_joined(old, n, *new) for old, (new, n) in zip(before, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), texts, pa.array(rows, _FOUND_ARROW)], names=["row", "text", "found"])
    return run


def _joined(old, n_words, hits, items, matches):
    matches = [dict(zip(("word", "item", "item_word", "length"), m)) for m in matches]
    if old:
        hits = np.union1d(np.frombuffer(old["hits"], np.int64), hits)
        items, matches = sorted({*old["items"], *items}), old["matches"] + matches
    return {"n_words": n_words, "hits": hits.astype(np.int64).tobytes(), "items": items, "matches": matches}


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    return marked(docs, benchmark, **options).where(~F.col("found.contaminated")).select("row.*")
