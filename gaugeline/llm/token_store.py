"""Token ids in a binary store that suits short documents.

Each document's ids, with an end id, are one zstandard frame, compressed alone with a
dictionary that all documents share. The dictionary is trained on the serialised ids
of a bounded sample. Frames lie one after another in blocks; a block carries the hash
of its dictionary and an index of document ids, offsets and token counts, so one
document is read by decompressing its frame only.

Layout under the store's path, written by Spark so that any shared file system will do:

* ``dictionary``: ``hash``, ``dictionary`` (one row);
* ``blocks``: ``shard``, ``block``, ``first_id``, ``last_id``, ``dictionary_hash``,
  ``width`` (bytes per id), ``doc_ids``, ``offsets`` (one more than documents),
  ``n_tokens``, ``payload``. Documents ascend within blocks, blocks within shards.

Edge cases: null and empty texts are a document of the end id; a null document id sorts
first; documents with equal ids stay side by side, ordered by content; other columns
are left out; an empty table gives a store without documents.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialise
from .packing import RUN_BYTES, with_end
from .tokens import encoder, runs

END = 1
#: The dictionary's sample: documents, pieces of each at most, ids of a piece; the dictionary's size.
SAMPLE_DOCS, PIECES, SAMPLE_IDS, DICTIONARY_BYTES = 1_000, 16, 1_024, 65_536
DOCS_PER_SHARD, MAX_SHARDS, BLOCK_BYTES = 1_024, 4_096, 1 << 20

_BLOCKS = ("shard int, block int, first_id bigint, last_id bigint, dictionary_hash string, width int, "
           "doc_ids array<bigint>, offsets array<bigint>, n_tokens array<bigint>, payload binary")


def _encoded(docs: DataFrame, tokenizer: str, end: int, width: int, dictionary: bytes | None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``frame``: compressed with a dictionary, or plain without."""
    def run(batches):
        import zstandard
        pieces = encoder(tokenizer)
        press = None if dictionary is None else _compressor(zstandard, dictionary)
        for batch in batches:
            for start, stop in runs(batch.column("text"), RUN_BYTES):
                ids, ends = with_end(*pieces.encode(batch.column("text").slice(start, stop - start)), end)
                data, places = memoryview(ids.astype(f"<u{width}").tobytes()), [width * e for e in ends]
                frames = [data[low:high] for low, high in zip(places, places[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), pa.array(np.diff(ends)),
                     pa.array([bytes(f) if press is None else press.compress(f) for f in frames], pa.binary())],
                    names=["doc_id", "n_tokens", "frame"])
    return docs.mapInArrow(run, "doc_id bigint, n_tokens bigint, frame binary")


def _compressor(zstandard, dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=False)


def train_dictionary(docs: DataFrame, tokenizer: str, end: int, width: int) -> bytes:
    """A dictionary from a sample chosen by hash; empty when the sample is too small."""
    import zstandard
    # The sample is chosen by ids alone, so that no text is sorted or sent.
    chosen = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    # Pieces from all over a document, evenly spread if it has more than PIECES of them.
    step = F.greatest(F.lit(SAMPLE_IDS), F.ceil(F.col("n_tokens") / PIECES).cast("int")).cast("bigint")
    places = F.sequence(F.lit(0).cast("bigint"), F.col("n_tokens") - 1, step)
    piece = F.expr(f"substring(frame, int(place * {width} + 1), {SAMPLE_IDS * width})")
    rows = _encoded(sample, tokenizer, end, width, None).select(
        "doc_id", "frame", F.explode(places).alias("place")).select("doc_id", piece.alias("ids")).collect()
    samples = [bytes(r["ids"]) for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["ids"]))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_store(docs: DataFrame, path: str, tokenizer: str, end: int = END,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    docs = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, end, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "hash string, dictionary binary").write.parquet(
        f"{path}/dictionary")
    # Shards are ranges of ids; their bounds come from the ids alone.
    count = docs.count()
    shards = min(max(1, count // DOCS_PER_SHARD), MAX_SHARDS)
    bounds = []
    if shards > 1:
        shares = [i / shards for i in range(1, shards)]
        bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []))
    shard = F.lit(0)
    if bounds:
        known = F.array(*[F.lit(b) for b in bounds])
        shard = F.coalesce(F.size(F.filter(known, lambda b: b < F.col("doc_id"))), F.lit(0))
    frames = _encoded(docs, tokenizer, end, width, dictionary).withColumn(
        "shard", F.when(F.col("doc_id").isNull(), 0).otherwise(shard))
    (frames.repartition("shard").sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "frame")
     .mapInArrow(_blocks(digest, width), _BLOCKS).write.parquet(f"{path}/blocks"))


def _blocks(digest: str, width: int):
    def run(batches):
        shard, block, held, size = None, 0, [], 0

        def row():
            ids, counts, frames = zip(*held)
            known = [i for i in ids if i is not None]
            return {"shard": shard, "block": block, "first_id": min(known, default=None),
                    "last_id": max(known, default=None), "dictionary_hash": digest, "width": width,
                    "doc_ids": list(ids), "n_tokens": list(counts), "payload": b"".join(frames),
                    "offsets": np.cumsum([0, *map(len, frames)]).tolist()}
        for batch in batches:
            rows = []
            for k, *document in zip(*(batch.column(c).to_pylist() for c in
                                      ("shard", "doc_id", "n_tokens", "frame"))):
                if held and (k != shard or size >= BLOCK_BYTES):
                    rows.append(row())
                    block, held, size = (block + 1 if k == shard else 0), [], 0
                shard = k
                held.append(document)
                size += len(document[2])
            if rows:
                yield _block_batch(rows)
        if held:
            yield _block_batch([row()])
    return run


_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()),
    ("dictionary_hash", pa.string()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("offsets", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("payload", pa.binary())])


def _block_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row["dictionary"]).hexdigest() != row["hash"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return row["hash"], bytes(row["dictionary"])


def _opener(digest: str, dictionary: bytes):
    import zstandard
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    press = zstandard.ZstdDecompressor(dict_data=shared)

    def ids_of(block: dict, k: int) -> np.ndarray:
        if block["dictionary_hash"] != digest:
            raise ValueError("a block names another dictionary than its store has")
        frame = block["payload"][block["offsets"][k]:block["offsets"][k + 1]]
        return np.frombuffer(press.decompress(frame), f"<u{block['width']}").astype(np.uint32)
    return ids_of


def read_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``
    and with ``with_ids`` the ids of every document."""
    digest, dictionary = _dictionary(spark, path)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.select("shard", "block", F.aggregate(
        "n_tokens", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("tokens"))
    # Starts of shards from one row per shard, of which there are at most MAX_SHARDS;
    # starts of blocks within each shard.
    by_shard = totals.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    shard_start = by_shard.select("shard", (F.sum("tokens").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))).alias("shard_start"))
    starts = totals.join(shard_start, "shard").select("shard", "block", (
        F.coalesce("shard_start", F.lit(0)) + F.coalesce(F.sum("tokens").over(
            Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0))).alias("block_start"))
    starts = materialise(starts, "block-starts")

    def run(batches):
        ids_of = _opener(digest, dictionary)
        for batch in batches:
            for block in batch.to_pylist():
                own = [ids_of(block, k) for k in range(len(block["doc_ids"]))]
                counts = np.array([len(ids) for ids in own], np.int64)
                place = [pa.array([block[c]] * len(own), pa.int32()) for c in ("shard", "block")]
                arrays = [pa.array(block["doc_ids"], pa.int64()), *place,
                          pa.array(np.cumsum(counts) - counts), pa.array(counts),
                          pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in own], pa.int64())]
                names = ["doc_id", "shard", "block", "in_block", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([ids.astype(np.int32) for ids in own], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    documents = blocks.mapInArrow(run, "doc_id bigint, shard int, block int, in_block bigint, n_tokens "
                                  "bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)
    return documents.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each, should the id occur repeatedly)."""
    digest, dictionary = _dictionary(spark, path)
    ids_of = _opener(digest, dictionary)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").where(
        (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)
        & F.array_contains("doc_ids", F.lit(doc_id).cast("bigint")))
    return [ids_of(block.asDict(), k) for block in blocks.toLocalIterator()
            for k, name in enumerate(block["doc_ids"]) if name == doc_id]
