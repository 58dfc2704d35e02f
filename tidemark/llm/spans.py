"""Runs of words to take out of documents: merging them and cutting them out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import unused
from tidemark.llm.words import Words, slices, split, text_bytes

SPANS = "doc_id long, text_hash int, start int, n int"


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text; rows that share an id are told apart by it."""
    return docs.select(F.col("doc_id").cast("long"), "text", F.hash("text").alias("text_hash"))


def runs(flags: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of set flags over which all of ``same`` stay equal
    (differences of one from row to row are for the caller to subtract)."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = np.diff(at) != 1
    for x in same:
        new[1:] |= x[at[1:]] != x[at[:-1]]
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1]


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the list of their spans, null where there are none. A row without an
    id has none."""
    listed = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return docs.withColumn("text_hash", F.hash("text")).join(listed.hint("merge"), ["doc_id", "text_hash"], "left")


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, and ``kept``: the words no span covers, joined by one space."""
    rows = with_spans(docs.select(F.col("doc_id").cast("long"), "text"), spans)
    return rows.select("doc_id", "text", "spans.start", "spans.n").mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")


def without(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the words of ``spans`` and the white space after each of them taken out of their
    texts, and n_chars, if there is such a column, counted anew for these; all other rows stay as they are, nulls too."""
    doc, text_hash, held, start, n, cut = unused(docs, "_doc", "_hash", "_spans", "_start", "_n", "_cut")
    listed = spans.groupBy(F.col("doc_id").alias(doc), F.col("text_hash").alias(text_hash)).agg(F.collect_list(F.struct("start", "n")).alias(held))
    same = (docs["doc_id"] == F.col(doc)) & (F.hash(docs["text"]) == F.col(text_hash))
    rows = docs.join(listed.hint("merge"), same, "left").select(*(docs[x] for x in docs.columns), F.col(held)["start"].alias(start), F.col(held)["n"].alias(n))
    kinds = T.StructType([*docs.schema.fields, T.StructField(cut, T.BooleanType())])
    done = rows.mapInArrow(lambda batches: _without(batches, start, n, cut), kinds)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col(cut), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", n_chars)
    return done.select(*docs.columns)


def _flags(part: pa.RecordBatch, words: Words, start: str = "start", n: str = "n") -> np.ndarray:
    """Whether each word is in one of its document's spans."""
    edges = np.zeros(len(words.start) + 1, np.int64)
    lists = part.column(start)
    doc = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False))
    begin = words.first[doc] + lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + part.column(n).flatten().to_numpy(zero_copy_only=False), -1)
    return np.cumsum(edges[:-1]) > 0


def _without(batches: Iterator[pa.RecordBatch], start: str, n: str, cut: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            words = split(data, offsets)
            gone = np.flatnonzero(_flags(part, words, start, n))
            # up to the next word of the document or its end
            after = np.append(words.start, len(data))[gone + 1]
            edges = np.zeros(len(data) + 1, np.int8)
            np.add.at(edges, words.start[gone], 1)
            np.add.at(edges, np.minimum(after, offsets[words.doc[gone] + 1]), -1)
            kept = np.cumsum(edges[:-1], dtype=np.int8) == 0
            text = strings(data[kept], np.append(0, np.cumsum(kept))[offsets[1:]])
            text = pc.if_else(part.column("text").is_valid(), text, pa.scalar(None, pa.string()))
            names = [x for x in part.schema.names if x not in (start, n)]
            columns = [text if x == "text" else part.column(x) for x in names]
            yield pa.RecordBatch.from_arrays([*columns, part.column(start).is_valid()], [*names, cut])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            words = split(data, offsets)
            kept = ~_flags(part, words)
            text, ends = joined(data, words, kept)
            n = words.counts
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(n - np.diff(np.append(0, np.cumsum(kept))[words.first])), strings(text, ends)],
                ["doc_id", "n_words", "n_removed", "kept"],
            )


def joined(data: np.ndarray, words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each document, joined by one space, and each document's end in them."""
    at = np.flatnonzero(kept)
    # a kept word takes its bytes and, if another one of its document follows, the byte after it
    more = np.zeros(len(at), np.int64)
    more[:-1] = words.doc[at[1:]] == words.doc[at[:-1]]
    edges = np.zeros(len(data) + 1, np.int8)
    edges[words.start[at]] += 1
    np.subtract.at(edges, words.end[at] + more, 1)
    mask = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    out = data.copy()
    out[words.end[at[more > 0]]] = 32
    sizes = words.end[at] - words.start[at] + more
    return out[mask], np.append(0, np.cumsum(sizes))[np.searchsorted(at, words.first[1:])]


def strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.append(0, ends).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
