"""Windows of words that an earlier document holds too, found with super-k-mers.

The minimiser of a window is the m-gram of its words with the smallest fingerprint. Consecutive
windows with one minimiser form a super-k-mer; it travels once, as a packed string of its words, to
the bucket of its minimiser, where equal windows must meet. There the strings are cut into windows
again, windows are sorted by fingerprint, and each run of equal windows gives the smallest document
that holds them. m-grams of three words keep buckets even: no single word or pair picks one.

Copies combine before they travel: of equal super-k-mers in a slice of a task's input only those of
its smallest document go on, since that one already decides on the others, so a bucket gets one
string for each slice that holds it, not one for each copy.

A minimiser may still stand in very many different strings, such as one at the edge of a line that a third
of all documents share. Minimisers are counted on a sample of strings first; those with more strings
than a mean bucket holds are hot, fewer than there are buckets. Their windows travel one by one to
the bucket of the window itself, and of equal ones a task sends only the first. The sample decides where
strings go, not what is found: a window's minimiser is the same everywhere.

Rows with a null id are left whole and take no part. Texts that are null or shorter than a window
have no windows. Rows of one id never take words from each other. A repeated row loses what the
other one loses.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, ship, stage
from tidemark.llm.spans import SPANS, cut, keyed, runs
from tidemark.llm.words import _BASE, _BASE_2, SPACES, Words, mix, slices, sliding_argmin, spans, split, starts_of, text_bytes, windows

#: One of so many strings is counted to find hot minimisers.
SAMPLED = 64
#: Windows of hot minimisers whose first document a task remembers.
REMEMBERED = 200_000
#: Buckets for each shuffle partition; a task holds one bucket at a time.
BUCKETS = 8
#: Bytes a task gathers for its buckets before it packs them.
GATHERED = 64 << 20
MOVED = "bucket int, found boolean, blob binary"


def _pack(*arrays: np.ndarray, text: bytes = b"") -> bytes:
    out = io.BytesIO()
    for x in arrays:
        np.save(out, x, allow_pickle=False)
    out.write(text)
    return zstandard.ZstdCompressor(level=6).compress(out.getvalue())


def _unpack(blob: bytes, arrays: int) -> tuple[list[np.ndarray], bytes]:
    raw = io.BytesIO(zstandard.ZstdDecompressor().decompress(blob))
    return [np.load(raw, allow_pickle=False) for _ in range(arrays)], raw.read()


class _Gathered:
    """What a task sends to each bucket, kept until it is worth packing."""

    def __init__(self, limit: int = GATHERED):
        self.limit, self.held, self.size = limit, {}, 0

    def add(self, bucket: int, arrays: list[np.ndarray], text: bytes = b"") -> None:
        self.held.setdefault(bucket, []).append((arrays, text))
        self.size += len(text) + sum(x.nbytes for x in arrays)

    def rows(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.size >= self.limit or last:
            for bucket, parts in self.held.items():
                arrays = [np.concatenate(x) for x in zip(*(a for a, _ in parts), strict=True)]
                yield _row(bucket, False, _pack(*arrays, text=b"\n".join(t for _, t in parts)))
            self.held, self.size = {}, 0


def _runs(words: Words, one: np.ndarray, size: int, gram: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Super-k-mers of a slice: first word, end, minimiser, and whether that one is hot."""
    at = starts_of(words.first, size)
    grams = windows(one, gram)
    least = sliding_argmin(grams, size - gram + 1)[at] if len(at) else at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(least) != 0)
    single = np.zeros(len(at), bool)
    if len(hot) and len(at):
        found = np.minimum(np.searchsorted(hot, grams[least]), len(hot) - 1)
        single = hot[found] == grams[least]
        new |= single  # every window of a hot minimiser by itself
    first = np.flatnonzero(new)
    begin = at[first]
    last = at[np.append(first[1:], len(at)) - 1] if len(first) else begin
    return begin, last + size, grams[least[first]], single[first]


def _sample(batches: Iterator[pa.RecordBatch], size: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Minimisers of a sample of a task's strings, and of all their number (as the minimiser 0)."""
    held, total = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            words = split(*text_bytes(part.column("text")))
            one = words.hashes(_BASE)
            begin, end, grams, _ = _runs(words, one, size, gram, np.empty(0, np.uint64))
            total += len(begin)
            held.append(grams[mix(spans(one, begin, end, _BASE)) % np.uint64(SAMPLED) == 0])
    grams, n = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(0, grams.view(np.int64))), pa.array(np.append(total, n * SAMPLED))], ["gram", "n"])


def hot_minimisers(docs: DataFrame, size: int, gram: int, buckets: int) -> np.ndarray:
    """Minimisers with more strings than a mean bucket; fewer than ``buckets`` by that."""
    counts = docs.select("text").mapInArrow(lambda it: _sample(it, size, gram), "gram long, n long")
    counts = stage(counts.groupBy("gram").agg(F.sum("n").alias("n")), "minimisers")
    total = counts.where("gram = 0").agg(F.max("n")).first()[0] or 0
    hot = counts.where((F.col("gram") != 0) & (F.col("n") > max(total / buckets, 4 * SAMPLED)))
    return np.sort(np.array([r["gram"] for r in hot.select("gram").collect()], np.int64).view(np.uint64))


def _travel(batches: Iterator[pa.RecordBatch], size: int, gram: int, buckets: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    turn, gathered = 0, _Gathered()
    known: dict[tuple[int, int], int] = {}  # windows of hot minimisers: smallest document so far
    for batch in batches:
        for part in slices(batch.filter(batch.column("doc_id").is_valid()), "text"):
            data, offsets = text_bytes(part.column("text"))
            words = split(data, offsets)
            one, two = words.hashes(_BASE), words.hashes(_BASE_2)
            begin, end, grams, single = _runs(words, one, size, gram, hot)
            if not len(begin):
                continue
            doc = words.doc[begin]
            ids = part.column("doc_id").to_numpy()
            hashes = part.column("text_hash").to_numpy()
            # equal super-k-mers side by side, those of the smallest document first
            a, b = spans(one, begin, end, _BASE), spans(two, begin, end, _BASE_2)
            order = np.lexsort((ids[doc], b, a))
            head = np.ones(len(order), bool)
            head[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
            kind = np.cumsum(head) - 1
            heads = order[head]
            held = ids[doc[order]] != ids[doc[heads]][kind]  # an earlier document of this slice has it
            late = np.zeros(len(heads), bool)
            hots = np.flatnonzero(single[heads])
            for k, *key, own in zip(hots.tolist(), a[heads[hots]].tolist(), b[heads[hots]].tolist(), ids[doc[heads[hots]]].tolist(), strict=True):
                before = known.get(tuple(key))
                if before is not None and before < own:  # or of this task
                    late[k] = True
                elif before is not None or len(known) < REMEMBERED:
                    known[tuple(key)] = own
            held |= late[kind]
            if held.any():
                flags = np.zeros(len(begin), bool)
                flags[order[held]] = True
                x, y = runs(flags, doc)
                start = begin[x] - words.first[doc[x]]
                blob = _pack(ids[doc[x]], hashes[doc[x]], start.astype(np.int32), (end[y] - begin[x]).astype(np.int32))
                yield _row(turn % buckets, True, blob)
                turn += 1
            # the others by bucket; one that occurs several times in its document is repeated
            order = order[~held]
            target = (mix(np.where(single, a, grams)[order]) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(target, kind="stable")
            own, target = order[by], target[by]
            raw = np.where(SPACES[data], np.uint8(32), data).tobytes()
            texts = [raw[i:j] for i, j in zip(words.start[begin[own]].tolist(), words.end[end[own] - 1].tolist(), strict=True)]
            start = (begin[own] - words.first[doc[own]]).astype(np.int32)
            edges = np.flatnonzero(np.diff(target, prepend=-1, append=buckets))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                gathered.add(int(target[i]), [ids[doc[own[i:j]]], hashes[doc[own[i:j]]], start[i:j]], b"\n".join(texts[i:j]))
            yield from gathered.rows()
    yield from gathered.rows(last=True)


def _row(bucket: int, found: bool, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([found]), pa.array([blob], pa.binary())], ["bucket", "found", "blob"])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """One bucket after another with its blobs of strings and of spans; rows come sorted by bucket."""
    now, strings, found = None, [], []
    for batch in batches:
        for bucket, done, blob in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if bucket != now and (strings or found):
                yield now, strings, found
                strings, found = [], []
            now = bucket
            (found if done else strings).append(blob)
    if strings or found:
        yield now, strings, found


def _count(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for _, strings, found in _by_bucket(batches):
        for blob in found:
            yield _spans(*_unpack(blob, 4)[0])
        if not strings:
            continue
        arrays, texts = zip(*(_unpack(blob, 3) for blob in strings), strict=True)
        doc, text_hash, start = (np.concatenate(x) for x in zip(*arrays, strict=True))
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        words = split(data, np.concatenate([[0], np.flatnonzero(data == 10) + 1, [len(data)]]))
        at = starts_of(words.first, size)
        a = windows(words.hashes(_BASE), size, _BASE)[at]
        b = windows(words.hashes(_BASE_2), size, _BASE_2)[at]
        order = np.argsort(a)
        same = np.diff(a[order]) == 0
        if (np.diff(b[order])[same] != 0).any():
            order = np.lexsort((b, a))
            same = (np.diff(a[order]) == 0) & (np.diff(b[order]) == 0)
        owner = doc[words.doc[at]]
        head = np.flatnonzero(np.concatenate([[True], ~same]))
        least = np.repeat(np.minimum.reduceat(owner[order], head), np.diff(np.append(head, len(order))))
        late = np.zeros(len(at), bool)
        late[order] = owner[order] > least
        if not late.any():
            continue
        # windows of each string are consecutive in ``at``
        per = words.counts - size + 1
        string = np.repeat(np.arange(len(per)), per)
        x, y = runs(late, string)
        who = string[x]
        begin = start[who] + x - (np.cumsum(per) - per)[who]
        yield _spans(doc[who], text_hash[who], begin.astype(np.int32), (y - x + size).astype(np.int32))


def _spans(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc_id", "text_hash", "start", "n"])


def earlier_windows(docs: DataFrame, size: int = 13, gram: int = 3) -> DataFrame:
    """Spans (doc_id, text_hash, start, n) of words covered by windows of ``size`` words that also
    start in a document with a smaller id."""
    if not 1 <= gram <= size or size < 2:
        raise ValueError("a window needs two words or more, and its minimiser no more than it has")
    spark = docs.sparkSession
    ship(spark)
    parts = partitions(spark)
    buckets = parts * BUCKETS
    hot = hot_minimisers(docs, size, gram, buckets)
    moved = keyed(docs).mapInArrow(lambda it: _travel(it, size, gram, buckets, hot), MOVED)
    return moved.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _count(it, size), SPANS)


def dedup(docs: DataFrame, size: int = 13, gram: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and ``kept``, its words outside these windows."""
    return cut(docs, earlier_windows(docs, size, gram))
