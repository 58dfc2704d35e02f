"""Token files: documents' ids packed in the fewest bits a vocabulary needs.

Files are written by Spark's Parquet committer, so they live in any store, appear whole or not at
all, and a repeated task replaces its own. A file row is a block of whole documents: their ids
(``doc_ids``, little-endian int64), numbers of ids (``lengths``, uint32) and ``payload``, in which
id k takes bits ``k * width`` to ``(k + 1) * width - 1``, lowest bit first. A block says which shard it
is in, how many ids of the shard are before it, and its number of ids; with the sums of the shards
this gives every id's place in the whole. A reader of some ids gives bounds of shard and first id, which Parquet compares with
its statistics, and reads the payload of no other row groups and pages (:func:`blocks_at`).

Order is that of ``doc_id`` (nulls first; rows of one id by a hash of their text). Null text is
empty; a document without words holds the end id alone. An empty table gives no blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, ship
from tidemark.llm.tokens import ENCODED, Encoder, crc, with_end
from tidemark.llm.words import slices

#: Ids after which a block is closed; a document is never divided between blocks.
BLOCK_IDS = 1 << 18

BLOCKS = (
    "shard int, block int, first long, n_ids long, n_docs int, width int, vocabulary long,"
    " first_doc long, last_doc long, doc_ids binary, lengths binary, payload binary"
)
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def width_of(vocabulary: int) -> int:
    """Bits that the ids 0 .. vocabulary - 1 need."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    ids = np.ascontiguousarray(ids, "<u4")
    if width % 8 == 0:
        return ids.view(np.uint8).reshape(-1, 4)[:, : width // 8].tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack_bits(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """Ids ``start`` .. ``start + count - 1`` of a block; reads only the bytes that hold them."""
    at, to = start * width, (start + count) * width
    raw = np.frombuffer(payload, np.uint8)[at // 8 : -(-to // 8)]
    if width % 8 == 0:
        full = np.zeros((count, 4), np.uint8)
        full[:, : width // 8] = raw.reshape(count, width // 8)
        return full.view("<u4").reshape(-1)
    bits = np.unpackbits(raw, bitorder="little")[at % 8 : at % 8 + count * width].reshape(count, width)
    full = np.zeros((count, 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(-1)


def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str, vocabulary: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, width = Encoder.of(tokenizer), width_of(vocabulary)
    shard, block, first = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        for part in slices(batch, "text", ENCODED):
            ids, offsets = with_end(*encoder.batch(part.column("text")), end_id)
            if len(ids) and int(ids.max()) >= vocabulary:
                raise ValueError(f"id {ids.max()} in a vocabulary of {vocabulary}")
            docs = part.column("doc_id").to_pylist()
            known = np.array([x is not None for x in docs])
            numbers = np.array([x or 0 for x in docs], "<i8")
            at = 0
            while at < len(docs):
                # documents without an id (they come first) are kept apart from the others
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_IDS, "right")) - 1)
                to = at + int(np.argmax(np.append(known[at:to] != known[at], True)))
                n = int(offsets[to] - offsets[at])
                row = {
                    "shard": shard, "block": block, "first": first, "n_ids": n, "n_docs": to - at, "width": width, "vocabulary": vocabulary,
                    "first_doc": docs[at], "last_doc": docs[to - 1],
                    "doc_ids": numbers[at:to].tobytes() if known[at] else None,
                    "lengths": np.diff(offsets[at : to + 1]).astype("<u4").tobytes(),
                    "payload": pack_bits(ids[offsets[at] : offsets[to]], width),
                }
                yield pa.RecordBatch.from_pylist([row], SCHEMA)
                block, first, at = block + 1, first + n, to


SCHEMA = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("n_docs", pa.int32()), ("width", pa.int32())]
    + [("vocabulary", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64())]
    + [(x, pa.binary()) for x in ("doc_ids", "lengths", "payload")]
)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int, shards: int | None = None) -> None:
    """Writes ``docs`` (doc_id, text) to token files under ``path``, one shard for each range of ids."""
    spark = docs.sparkSession
    ship(spark)
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(shards or partitions(spark), "doc_id")
        .sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"))
    )
    blocks = ordered.mapInArrow(lambda it: _encode(it, tokenizer, vocabulary, end_id), BLOCKS)
    blocks.write.option("compression", "none").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """Ids before each shard; as many numbers as there are shards."""
    totals = spark.read.schema(BLOCKS).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    starts, before = {}, 0
    for shard, n in sorted(map(tuple, totals)):
        starts[shard], before = before, before + n
    return starts


def _documents(row: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    ids = unpack_bits(row["payload"], row["width"], 0, row["n_ids"])
    ends = np.cumsum(np.frombuffer(row["lengths"], "<u4").astype(np.int64))
    docs = [None] * row["n_docs"] if row["doc_ids"] is None else np.frombuffer(row["doc_ids"], "<i8").tolist()
    at = 0
    for doc, end in zip(docs, ends.tolist(), strict=True):
        yield doc, at, ids[at:end]
        at = end


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: its place, number of ids and their crc32."""
    starts = shard_starts(spark, path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                base = starts[row["shard"]] + row["first"]
                out = [(doc, base + at, len(ids), crc(ids)) for doc, at, ids in _documents(row)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.read.schema(BLOCKS).parquet(path).select("shard", "first", "n_ids", "n_docs", "width", "doc_ids", "lengths", "payload").mapInArrow(rows, DIGEST)


def blocks_at(spark: SparkSession, path: str, start: int, count: int) -> DataFrame | None:
    """Blocks that hold the ids ``start`` .. ``start + count - 1``, with the number of ids before each (``at``); None if none does.

    The payload is read where shard and first id lie in bounds that Parquet compares with the statistics of row groups and pages.
    The bounds come from the places of blocks in the shards asked for, without their payload.
    """
    starts, end = shard_starts(spark, path), start + count
    order = [*starts, None]
    # a shard's ids end where the next one's begin; what is asked for is in all shards between two
    inside = [s for s, after in zip(order, order[1:], strict=False) if starts[s] < end and (after is None or starts[after] > start)]
    if not inside or count <= 0:
        return None
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # Only the first shard is entered in its middle, and only the last one left there.
    one, last = inside[0], inside[-1]
    shard, first = F.col("shard"), F.col("first")
    entered = blocks.where((shard == one) & (first <= max(0, start - starts[one]))).agg(F.max("first")).first()[0]
    after, before = first >= entered, first < end - starts[last]
    if one == last:
        wanted = (shard == one) & after & before
    else:
        wanted = shard.between(one, last) & ((shard > one) | after) & ((shard < last) | before)
    base = F.element_at(F.create_map(*[F.lit(x) for s in inside for x in (s, starts[s])]), F.col("shard"))
    return blocks.where(wanted).select("width", "n_ids", "payload", (base + F.col("first")).alias("at"))


def read_ids(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """Ids ``start`` .. ``start + count - 1`` of the whole, from the blocks that hold them; ``count`` is for the
    caller to keep small. Places outside the files hold nothing."""
    found, out = blocks_at(spark, path, start, count), [np.empty(0, np.uint32)]
    for row in found.orderBy("at").collect() if found is not None else ():
        a, b = max(0, start - row["at"]), min(row["n_ids"], start + count - row["at"])
        if a < b:
            out.append(unpack_bits(row["payload"], row["width"], a, b - a))
    return np.concatenate(out)
