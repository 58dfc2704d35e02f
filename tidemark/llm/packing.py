"""Best-fit packing of documents into sequences, in bulk-synchronous steps.

A document is its ids and an end id; one longer than a sequence is cut into full pieces and a rest.
Pieces are sorted by length without moving them: each task counts its pieces of each length, running
sums of these counts over the tasks give every piece its rank among those of its length, and pieces
of one length are interchangeable. A step then handles all pieces of one length, longest first. It
sweeps the gaps that are long enough in ascending order (the successor of a length is the smallest
such gap), gives the pieces with the lowest ranks to the first gaps, as many as go into each, opens
sequences for those left, and files the gaps under their new sizes before the next step. Step by
step this is what best fit decreasing does piece by piece.

Lengths and gaps are at most ``capacity``, so counts, steps and the plan they give are bounded by it
whatever the number of documents; the plan goes to the executors, which work out each piece's
sequence and offset from its rank.

Null text is an empty document (the end id alone). Repeated rows are packed as often as they occur.
Null ids are kept. An empty table gives no pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stage
from tidemark.llm.tokens import ENCODED, Encoder, crc, ragged, with_end
from tidemark.llm.words import slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, seat long"
PLAN = "length long, low long, high long, each long, sequence long, at long"


def _cut(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int, keep: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of each document; ``seat`` numbers the pieces of one length in this task."""
    encoder, task = Encoder.of(tokenizer), TaskContext.get().partitionId()
    taken = np.zeros(capacity + 1, np.int64)
    for batch in batches:
        for part in slices(batch, "text", ENCODED):
            ids, offsets = with_end(*encoder.batch(part.column("text")), end_id)
            total = np.diff(offsets)
            count = -(-total // capacity)
            doc = np.repeat(np.arange(len(total)), count)
            piece = ragged(np.zeros(len(total), np.int64), count)
            start = piece * capacity
            length = np.minimum(capacity, total[doc] - start)
            order = np.argsort(length, kind="stable")
            lengths, first, n = np.unique(length[order], return_index=True, return_counts=True)
            seat = np.empty(len(length), np.int64)
            seat[order] = np.arange(len(length)) - np.repeat(first, n) + np.repeat(taken[lengths], n)
            taken[lengths] += n
            begin = offsets[doc] + start
            runs = [ids[a:b] for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            columns = [
                part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                pa.array([crc(x) for x in runs], pa.int64()), pa.array(np.full(len(doc), task, np.int32)), pa.array(seat),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "seat"]
            if keep:
                columns.append(pa.array([x.astype("<u4").tobytes() for x in runs], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Steps over all lengths, longest first: plan rows and the number of sequences.

    A row (length, low, high, each, sequence, at) places the pieces of ``length`` with ranks low .. high - 1:
    ``each`` of them go into one sequence, the first at offset ``at`` of ``sequence``, and so on upwards.
    """
    plan, opened = [], 0
    sizes: list[int] = []  # gaps at hand, ascending
    ranges: dict[int, list[tuple[int, int]]] = {}  # by gap: first sequence and number of sequences

    def file(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in ranges:
                insort(sizes, gap)
                ranges[gap] = []
            ranges[gap].append((sequence, n))

    for length in sorted(counts, reverse=True):
        rank, left, changed = 0, counts[length], []

        def fill(sequence: int, n: int, gap: int) -> int:
            """Puts pieces into up to n sequences of one gap; the number that took some."""
            nonlocal rank, left
            each = gap // length
            full = min(n, left // each)
            rest = left - full * each if full < n else 0
            for some, k in ((full, each), (int(rest > 0), rest)):
                if some:
                    plan.append((length, rank, rank + some * k, k, sequence, capacity - gap))
                    changed.append((gap - k * length, sequence, some))
                    rank, left, sequence = rank + some * k, left - some * k, sequence + some
            return full + int(rest > 0)

        while left and (k := bisect_left(sizes, length)) < len(sizes):
            gap = sizes.pop(k)
            for sequence, n in ranges.pop(gap):
                used = fill(sequence, n, gap) if left else 0
                changed.append((gap, sequence + used, n - used))
        if left:
            opened += fill(opened, left, capacity)
        for x in changed:
            file(*x)
    return plan, opened


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, keep_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id,
    offset; with ``keep_ids`` also ids (little-endian uint32)."""
    spark = docs.sparkSession
    ship(spark)
    schema = PIECES + (", ids binary" if keep_ids else "")
    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: _cut(it, tokenizer, end_id, capacity, keep_ids), schema)
    # Ranks rest on the tasks' numbers, so they are written down before they are counted.
    pieces = stage(pieces, "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = best_fit(totals, capacity)
    # At most a few rows for each pair of a length and a gap that met.
    plan = spark.createDataFrame(plan, PLAN).withColumnRenamed("length", "of")
    rank = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("seat"))
    inside = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return rank.join(F.broadcast(plan), inside).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("each")) * F.col("length")).alias("offset"),
        *(["ids"] if keep_ids else []),
    )
