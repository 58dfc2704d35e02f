"""Passages of many words that an earlier document holds too, found with sparse suffix arrays.

Of all suffixes (a document from some word on) only those at minimisers are retained: the places whose
``head`` words have the smallest fingerprint among the places a passage of ``size`` words offers. The
choice rests on the words alone, so two equal passages retain the same suffix in both documents.

1. Heads are counted, and suffixes whose head stands in one document only are dropped. Minima and maxima
   are taken before the shuffle, so a head in a third of all documents is one row a task.
2. Documents get the list of their suffixes that are left. Each one travels with the words around it that its
   passages can reach (fewer than 2 x ``size``) to a range of heads; ranges are equal parts of the 64-bit fingerprints.
3. There suffixes are sorted by the words from their head on, and by the words before it, read backwards. The common
   length of neighbours in the first order says how far matches extend to the right, that of neighbours in the second
   how far to the left: suffixes that share a passage with ``k`` words before the head are those which no neighbour with
   less than ``k`` common words to the left, or ``size - k`` to the right, sets apart. The smallest document of them keeps it.

Within a slice of a task's input step 3 is done before anything travels, so of many copies only the first of each
slice does. Hot heads stand in more suffixes than a mean range holds and would make a range of their own as long as the corpus:
their passages are told apart by fingerprint instead, each of which travels alone to a bucket of its own choice.

The outcome is exact: a word is found if it is covered by ``size`` consecutive words that also stand in
a document with a smaller id. Words are compared by 64-bit fingerprints. Rows with a null id are left whole and take no
part. Texts that are null or shorter than a passage have none. Rows of one id never take words from each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, ship, stage
from tidemark.llm.spans import keyed, runs
from tidemark.llm.substrings import BUCKETS, MOVED, _by_bucket, _Gathered, _pack, _row, _unpack
from tidemark.llm.tokens import ragged
from tidemark.llm.words import mix, slices, sliding_argmin, split, starts_of, text_bytes, windows

#: Words of a passage, and of a suffix's head.
SIZE, HEAD = 50, 8
#: Suffixes that a hot head has at least.
LEAST_HOT = 200
#: Suffixes of whole heads that are sorted at a time; one head may have more.
SORTED = 4096
FOUND = "doc_id long, text_hash int, start int, n int, earlier long"


def _suffixes(batches: Iterator[pa.RecordBatch], size: int, head: int) -> Iterator[pa.RecordBatch]:
    """Retained suffixes: head, the passages (first start and number) whose minimiser it is, and words of the first before it."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = split(*text_bytes(part.column("text")))
            at = starts_of(words.first, size)
            if not len(at):
                continue
            heads = windows(words.hashes(), head)
            least = sliding_argmin(heads, size - head + 1)[at]
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) != 1) | (np.diff(least) != 0)
            first = np.flatnonzero(new)
            doc = words.doc[at[first]]
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(rows), part.column("text_hash").take(rows), pa.array(heads[least[first]].view(np.int64)),
                    pa.array((at[first] - words.first[doc]).astype(np.int32)), pa.array(np.diff(np.append(first, len(at))).astype(np.int32)),
                    pa.array((least[first] - at[first]).astype(np.int32)),
                ],
                ["doc_id", "text_hash", "head", "start", "n", "before"],
            )


def _extend(batches: Iterator[pa.RecordBatch], size: int, head: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Suffixes with the words around them by range of heads, passages of hot heads by bucket (numbered after the ranges);
    and passages found in the slice."""
    turn, gathered = 0, _Gathered()
    for batch in batches:
        for part in slices(batch, "text"):
            words = split(*text_bytes(part.column("text")))
            one = words.hashes()
            lists = part.column("start")
            doc = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
            start, n, before, heads = (part.column(k).flatten().to_numpy().astype(np.int64) for k in ("start", "n", "before", "head"))
            hot = part.column("hot").flatten().to_numpy(zero_copy_only=False).astype(bool)
            all_ids, all_hashes = part.column("doc_id").to_numpy(), part.column("text_hash").to_numpy()

            k = np.flatnonzero(~hot)
            ids, hashes, keys = all_ids[doc[k]], all_hashes[doc[k]], heads[k].view(np.uint64)
            around = n[k] + size - 1
            stretch = one[ragged(words.first[doc[k]] + start[k], around)]
            late, least = _sorted(keys, before[k], n[k], stretch, ids, size, head)
            suffix = np.repeat(np.arange(len(k)), n[k])
            if late.any():
                yield _row(turn % buckets, True, _pack(*_found(late, least, suffix, start[k], n[k], ids, hashes, size)))
                turn += 1
            range_ = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            begin = np.cumsum(around) - around
            # suffixes with a passage whose first document this is go on
            for to, rows in _dealt(np.flatnonzero(np.bincount(suffix[~late], minlength=len(k))), range_):
                own = k[rows]
                columns = [ids[rows], hashes[rows], keys[rows], *(x[own].astype(np.int32) for x in (start, n, before)), stretch[ragged(begin[rows], around[rows])]]
                gathered.add(to, columns)

            if hot.any():
                k = np.flatnonzero(hot)
                doc, start = np.repeat(doc[k], n[k]), ragged(start[k], n[k])
                print_ = windows(one, size)[words.first[doc] + start]
                ids, hashes, each = all_ids[doc], all_hashes[doc], np.ones(len(doc), np.int64)
                late, least = _compare(print_, ids)
                if late.any():
                    yield _row(turn % buckets, True, _pack(*_found(late, least, np.arange(len(doc)), start, each, ids, hashes, size)))
                    turn += 1
                for to, rows in _dealt(np.flatnonzero(~late), (mix(print_) % np.uint64(buckets)).astype(np.int64) + buckets):
                    gathered.add(to, [ids[rows], hashes[rows], start[rows].astype(np.int32), print_[rows]])
            yield from gathered.rows()
    yield from gathered.rows(last=True)


def _dealt(rows: np.ndarray, target: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each target with those of the rows that go to it."""
    rows = rows[np.argsort(target[rows], kind="stable")]
    edges = np.flatnonzero(np.diff(target[rows], prepend=-1, append=-1))
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(target[rows[i]]), rows[i:j]


def _sorted(heads: np.ndarray, before: np.ndarray, n: np.ndarray, words: np.ndarray, ids: np.ndarray, size: int, head: int) -> tuple[np.ndarray, np.ndarray]:
    """For each passage of each suffix: whether a smaller document has it, and the smallest document that does.
    ``words`` holds the n + size - 1 words around each suffix. Whole heads are sorted, some at a time."""
    around = n + size - 1
    first, begin = np.cumsum(around) - around, np.cumsum(n) - n
    least = np.repeat(ids, n)
    own = least.copy()
    order = np.argsort(heads, kind="stable")
    ends = np.flatnonzero(np.diff(heads[order], append=~heads[order][-1:]) != 0) + 1
    at = 0
    while at < len(order):
        to = ends[min(int(np.searchsorted(ends, at + SORTED)), len(ends) - 1)]
        rows, at = order[at:to], int(to)
        near = _neighbours(before[rows], n[rows], words[ragged(first[rows], around[rows])], ids[rows], size, head)
        if near is not None:
            least[ragged(begin[rows], n[rows])] = near
    return own > least, least


def _neighbours(before: np.ndarray, n: np.ndarray, words: np.ndarray, ids: np.ndarray, size: int, head: int) -> np.ndarray | None:
    """Smallest document of each passage of these suffixes; None where no two share a head."""
    around = n + size - 1
    at = np.cumsum(around) - around + before
    right, to_right = _array(words, at, around - before, size, 1)
    if not (to_right >= head).any():
        return None
    left, to_left = _array(words, at - 1, before, size - head, -1)
    least = np.repeat(ids, n)
    begin = np.cumsum(n) - n
    same_right, same_left = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    for k in range(size - head + 1):
        rows = np.flatnonzero((before >= k) & (before - n < k))  # those with a passage of k words before the head
        if len(rows) < 2:
            continue
        same_right[right[1:]] = np.cumsum(to_right < size - k)
        same_left[left[1:]] = np.cumsum(to_left < k)
        group = same_right[rows] * len(n) + same_left[rows]
        order = np.argsort(group, kind="stable")
        edge = np.flatnonzero(np.diff(group[order], prepend=-1))
        low = np.repeat(np.minimum.reduceat(ids[rows][order], edge), np.diff(np.append(edge, len(rows))))
        least[(begin + before - k)[rows[order]]] = low
    return least


def _array(words: np.ndarray, at: np.ndarray, length: np.ndarray, width: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of words that begin at ``at`` and go on by ``step``, and each one's words in common with the row before."""
    place = np.arange(width)
    held = place < length[:, None]
    rows = np.zeros(held.shape, np.uint64)
    rows[held] = np.maximum(words[(at[:, None] + step * place)[held]], np.uint64(1))  # 0 is the end of a row
    if not width:
        return np.arange(len(at)), np.zeros(max(0, len(at) - 1), np.int64)
    order = np.argsort(rows.astype(">u8").view(f"S{8 * width}").ravel(), kind="stable")
    same = rows[order[1:]] == rows[order[:-1]]
    common = np.where(same.all(axis=1), width, same.argmin(axis=1))
    # rows as long as what they share have ended together
    return order, np.minimum(common, np.minimum(length[order[1:]], length[order[:-1]]))


def _compare(print_: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each passage: whether a smaller document has it, and the smallest document that does."""
    order = np.argsort(print_)
    first = np.flatnonzero(np.append(True, np.diff(print_[order]) != 0)[: len(order)])
    least = np.empty_like(doc)
    if len(order):
        least[order] = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(order))))
    return doc > least, least


def _found(late, least, suffix, start, n, ids, hashes, size) -> list[np.ndarray]:
    """Runs of found passages of each suffix as runs of words."""
    x, y = runs(late, suffix)
    who = suffix[x]
    begin = np.cumsum(n) - n
    earlier = np.array([least[i : j + 1].min() for i, j in zip(x.tolist(), y.tolist(), strict=True)], np.int64)
    return [ids[who], hashes[who], (start[who] + x - begin[who]).astype(np.int32), (y - x + size).astype(np.int32), earlier]


def _meet(batches: Iterator[pa.RecordBatch], size: int, head: int, buckets: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "start", "n", "earlier"]
    for bucket, moved, found in _by_bucket(batches):
        for blob in found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _unpack(blob, 5)[0]], names)
        if not moved:
            continue
        columns = (np.concatenate(x) for x in zip(*(_unpack(blob, 7 if bucket < buckets else 4)[0] for blob in moved), strict=True))
        if bucket < buckets:
            ids, hashes, heads, start, n, before, words = columns
            n, before = n.astype(np.int64), before.astype(np.int64)
            late, least = _sorted(heads, before, n, words, ids, size, head)
        else:
            ids, hashes, start, print_ = columns
            n = np.ones(len(ids), np.int64)
            late, least = _compare(print_, ids)
        if late.any():
            suffix = np.repeat(np.arange(len(n)), n)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _found(late, least, suffix, start, n, ids, hashes, size)], names)


def earlier_passages(docs: DataFrame, size: int = SIZE, head: int = HEAD) -> DataFrame:
    """Spans (doc_id, text_hash, start, n, earlier) of words covered by passages of ``size`` words that
    also stand in a document with a smaller id, ``earlier`` being one such document. Spans of one
    document may touch and overlap."""
    if not 1 <= head <= size or size < 2:
        raise ValueError("a passage needs two words or more, and a head no more than it has")
    spark = docs.sparkSession
    ship(spark)
    parts = partitions(spark)
    rows = keyed(docs).where("doc_id IS NOT NULL")
    suffixes = stage(rows.mapInArrow(lambda it: _suffixes(it, size, head), "doc_id long, text_hash int, head long, start int, n int, before int"), "suffixes")
    buckets = parts * BUCKETS
    mean = suffixes.count() / buckets
    heads = suffixes.groupBy("head").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("times"))
    # written down, so that the join reads it anew and Spark can split the suffixes of a hot head
    shared = stage(heads.where("low < high").select("head", (F.col("times") > max(mean, LEAST_HOT)).alias("hot")), "heads")
    left = suffixes.join(shared, "head")
    listed = left.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n", "before", "head", "hot")).alias("suffixes"))
    # A repeated row would list its suffixes twice. Lists grow with the corpus: both sides are shuffled.
    listed = listed.withColumn("suffixes", F.array_distinct("suffixes"))
    with_lists = rows.join(listed.hint("merge"), ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", *(f"suffixes.{x}" for x in ("start", "n", "before", "head", "hot")))
    moved = with_lists.mapInArrow(lambda it: _extend(it, size, head, buckets), MOVED)
    return moved.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _meet(it, size, head, buckets), FOUND)


def passages(docs: DataFrame, size: int = SIZE, head: int = HEAD) -> DataFrame:
    """One row per found passage, whole: doc_id, text_hash, start (in words), n_words, earlier_doc_id."""
    listed = earlier_passages(docs, size, head).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n", "earlier")).alias("found"))
    flat = listed.select("doc_id", "text_hash", "found.start", "found.n", "found.earlier")
    return flat.mapInArrow(_merge, "doc_id long, text_hash int, start long, n_words long, earlier_doc_id long")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        doc = np.repeat(np.arange(len(batch)), np.diff(batch.column("start").offsets.to_numpy()))
        start, n, earlier = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in ("start", "n", "earlier"))
        order = np.lexsort((start, doc))
        doc, start, end, earlier = doc[order], start[order], (start + n)[order], earlier[order]
        # furthest end so far within a document, kept apart by a step between documents
        step = int(end.max()) + 1
        reach = np.maximum.accumulate(end + doc * step) - doc * step
        new = np.ones(len(doc), bool)
        new[1:] = (np.diff(doc) != 0) | (start[1:] > reach[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(doc)) - 1
        rows = pa.array(doc[first])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(start[first]), pa.array(reach[last] - start[first]), pa.array(np.minimum.reduceat(earlier, first))],
            ["doc_id", "text_hash", "start", "n_words", "earlier_doc_id"],
        )
