"""Near duplicates by SetSketch registers, verified on whole shingle sets.

A document's set is its distinct five-word shingles (words in lower case A-Z); with fewer words, the
whole sequence. Register i of its sketch is the floor of a logarithm to base b of the smallest of
exponentially distributed hashes, one per shingle: exponentially spaced, cut to 16 bits, and the sketch
of a union is the larger of both registers. Registers of two sets agree about as often as the sets
overlap, so bands of registers find candidates:

1. Equal word sequences become one class, named by its smallest id, so exact copies cost nothing more.
2. Every band of a class's registers is a bucket. The hub of a bucket is its most popular class, the
   one whose buckets hold most classes in all: near copies of one text mostly share one hub.
3. Classes that share a hub form a group. Two classes that agree in any band are in the group of its
   hub, so comparing within groups loses no pair that a band finds, and a class travels once for each
   of its hubs, not once for each bucket or partner. Groups over ``CHUNK`` classes are dealt into chunks,
   and each pair of chunks is a group of its own: no task holds more than two chunks.
4. The joint likelihood of the registers, given both set sizes, rules out classes none of whose partners
   in the group can reach the similarity (at 0.55, over five standard errors below 0.75).
5. The texts of the rest travel to their groups, where all intersections are counted exactly. A group
   gives only the links that connect it, not its pairs.
6. Links meet in connected components.

With 32 bands of 4 registers a pair of similarity 0.75 meets in some band but for 5 cases in a
million, one of 0.8 but for 5 in a hundred million.

Null or wordless texts have empty sets and no links. Rows of one id count as one document: they share
a component. A row without an id keeps a null component and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, ship, stage
from tidemark.llm.components import components
from tidemark.llm.words import _BASE, _BASE_2, mix, slices, spans, starts_of, windows, words_of

SHINGLE = 5
#: Percent of the union that the intersection of a linked pair takes at least.
PERCENT = 75
REGISTERS, BAND = 128, 4
#: Base, rate and number of register values of the sketch.
B, RATE, LIMIT = 1.001, 20.0, 2**16 - 2
#: Classes of a group that one task compares; of a larger one, two chunks of it.
CHUNK = 2048
#: Similarity, as the likelihood has it, under which a partner is ruled out.
HOPELESS = 0.55
#: Text bytes sketched at once: shingles and their hashes stay in the cache.
SKETCHED = 1 << 20

_odd = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_FLIP, _TIMES = _odd[:REGISTERS], _odd[REGISTERS:]

SKETCHES = "doc_id long, text_hash long, c1 long, c2 long, n long, registers binary"


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one text after another; how many each has; and two
    fingerprints of each text's word sequence."""
    words = words_of(column, lower=True)
    one, counts = words.hashes(), words.counts
    at = starts_of(words.first, SHINGLE)
    docs = np.arange(len(counts))
    short = (counts > 0) & (counts < SHINGLE)
    whole = [spans(one if base == _BASE else words.hashes(base), words.first[:-1], words.first[1:], base) for base in (_BASE, _BASE_2)]
    shingles = np.concatenate([windows(one, SHINGLE)[at], whole[0][short]])
    owner = np.concatenate([words.doc[at], docs[short]])
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(owner), bool)
    new[1:] = (np.diff(shingles) != 0) | (np.diff(owner) != 0)
    return shingles[new], np.bincount(owner[new], minlength=len(counts)), *whole


def registers(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sketch of each set, a row each; of empty sets, zeros."""
    out = np.zeros((len(sizes), REGISTERS), np.uint16)
    some = np.flatnonzero(sizes)
    if len(some):
        first = np.cumsum(sizes[some]) - sizes[some]
        least = np.empty((len(some), REGISTERS), np.uint64)
        work = np.empty(len(shingles), np.uint64)
        for i in range(REGISTERS):
            np.bitwise_xor(shingles, _FLIP[i], out=work)
            np.multiply(work, _TIMES[i], out=work)
            least[:, i] = np.minimum.reduceat(work, first)
        exponential = -np.log1p(-(least + 0.5) / 2.0**64) / RATE
        out[some] = np.clip(np.floor(1 - np.log(exponential) / np.log(B)), 0, LIMIT + 1)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SKETCHED):
            shingles, sizes, c1, c2 = shingle_sets(part.column("text"))
            sketch = registers(shingles, sizes)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), pa.array(sizes), pa.array([x.tobytes() for x in sketch], pa.binary())],
                ["doc_id", "text_hash", "c1", "c2", "n", "registers"],
            )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (hub, one, two) after another; rows come sorted by these."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("hub", "one", "two")])
        edges = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)], strict=True):
            key = keys[:, i].tolist()
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _sides(chunk: np.ndarray, one: int, two: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows on both sides of a group's comparison: all against all, or one chunk against the other."""
    if one == two:
        every = np.arange(len(chunk))
        return every, every
    return np.flatnonzero(chunk == one), np.flatnonzero(chunk == two)


def may_reach(x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray, least: float = HOPELESS) -> np.ndarray:
    """For rows of sketches x against those of y: does the likelihood of their registers, jointly with
    the set sizes, still rise at the similarity ``least``, so that its maximum lies above?"""
    out = np.zeros((len(x), len(y)), bool)
    shrink, log_b = (B - 1) / B, np.log(B)

    def chance(t: np.ndarray) -> np.ndarray:  # of a register being larger, for the excess t of its set
        return -np.log1p(-np.maximum(t, 1e-12) * shrink) / log_b

    def slope(t: np.ndarray) -> np.ndarray:
        return shrink / (1 - np.maximum(t, 1e-12) * shrink) / log_b

    for i in range(0, len(x), 64):
        more = (x[i : i + 64, None, :] > y[None]).sum(axis=2)
        less = (x[i : i + 64, None, :] < y[None]).sum(axis=2)
        u = n_x[i : i + 64, None] / (n_x[i : i + 64, None] + n_y[None])
        v = 1 - u
        # sizes alone bound the similarity
        possible = np.minimum(u, v) / np.maximum(u, v) >= least
        a, b = u - v * least, v - u * least
        up, down = chance(a), chance(b)
        rises = -more * v * slope(a) / up - less * u * slope(b) / down + (REGISTERS - more - less) * (v * slope(a) + u * slope(b)) / np.maximum(1 - up - down, 1e-12)
        out[i : i + 64] = possible & (rises >= 0)
    return out


def _hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of groups without the classes that no partner can be similar to."""
    for group in _groups(batches):
        one, two = group.column("one")[0].as_py(), group.column("two")[0].as_py()
        chunk = group.column("chunk").to_numpy()
        a, b = _sides(chunk, one, two)
        if not len(a) or not len(b) or len(chunk) < 2:
            continue
        sketch = np.frombuffer(b"".join(group.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        n = group.column("n").to_numpy().astype(float)
        ok = may_reach(sketch[a], sketch[b], n[a], n[b])
        if one == two:
            np.fill_diagonal(ok, False)
        keep = np.zeros(len(chunk), bool)
        keep[a] |= ok.any(axis=1)
        keep[b] |= ok.any(axis=0)
        if keep.any():
            some = group.select(["hub", "one", "two", "chunk", "doc_id", "text_hash"]).filter(pa.array(keep))
            yield from some.combine_chunks().to_batches()


def intersections(sets: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a with sets b; ``sets`` has the sets one after another."""
    columns, code, df = np.unique(sets, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    shared = df[code] > 1
    code, row = code[shared], row[shared]
    left, right = np.full(len(sizes), -1), np.full(len(sizes), -1)
    left[a], right[b] = np.arange(len(a)), np.arange(len(b))
    out = np.zeros((len(a), len(b)), np.float32)
    used = np.unique(code)
    code = np.searchsorted(used, code)
    width = max(256, (1 << 22) // max(1, len(a) + len(b)))  # columns at a time: 16 MB
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    for at in range(0, len(used), width):
        i, j = np.searchsorted(code, [at, at + width])
        c, r = code[i:j] - at, row[i:j]
        x, y = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        x[left[r[left[r] >= 0]], c[left[r] >= 0]] = 1
        y[right[r[right[r] >= 0]], c[right[r] >= 0]] = 1
        out += x @ y.T
    return np.rint(out).astype(np.int64)


def _forest(linked: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Links that connect what ``linked`` connects: one for each row but the first of a component."""
    left, right = np.full(size, -1), np.full(size, -1)
    left[a], right[b] = np.arange(len(a)), np.arange(len(b))
    open_ = np.ones(size, bool)
    for root in range(size):
        if not open_[root]:
            continue
        open_[root] = False
        front = [root]
        while front:
            now = front.pop()
            near = np.zeros(size, bool)
            if left[now] >= 0:
                near[b] |= linked[left[now]]
            if right[now] >= 0:
                near[a] |= linked[:, right[now]]
            for other in np.flatnonzero(near & open_).tolist():
                open_[other] = False
                yield other, root
                front.append(other)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches):
        one, two = group.column("one")[0].as_py(), group.column("two")[0].as_py()
        chunk = group.column("chunk").to_numpy()
        a, b = _sides(chunk, one, two)
        if not len(a) or not len(b) or len(chunk) < 2:
            continue
        sets, sizes, _, _ = shingle_sets(group.column("text").combine_chunks())
        both = intersections(sets, sizes, a, b)
        linked = (100 + PERCENT) * both >= PERCENT * (sizes[a][:, None] + sizes[b][None])
        linked &= both > 0
        if one == two:
            np.fill_diagonal(linked, False)
        docs = group.column("doc_id").to_numpy()
        found = [(docs[x], docs[y]) for x, y in _forest(linked, a, b, len(chunk))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])


def _bands() -> F.Column:
    """Keys of a sketch's bands."""
    size = 2 * BAND
    return F.array(*[F.xxhash64(F.lit(k), F.substring("registers", 1 + k * size, size)) for k in range(REGISTERS // BAND)])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, two fingerprints of the word sequence, set size and registers of each row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(_sketch, SKETCHES)


def _grouped(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "hub", "one", "two").sortWithinPartitions("hub", "one", "two")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_shingles, component_id and kept (whether the row's id
    names its component)."""
    spark = docs.sparkSession
    parts = partitions(spark)
    rows = stage(sketches(docs), "sketches")
    sets = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = sets.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("n").alias("n"), F.first("registers").alias("registers"))
    classes = stage(classes.select("c1", "c2", "least.*", "n", "registers").withColumn("node", F.xxhash64("doc_id", "text_hash")), "classes")

    bands = classes.select("node", F.explode(_bands()).alias("bucket"))
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stage(bands.join(sizes, "bucket"), "shared")
    popular = shared.groupBy("node").agg(F.sum("size").alias("popularity"))
    hubs = shared.join(popular, "node").groupBy("bucket").agg(F.max(F.struct("popularity", "node")).alias("hub")).select("bucket", F.col("hub.node").alias("hub"))
    members = stage(shared.join(hubs, "bucket").select("node", "hub").distinct(), "members")

    # chunks of large groups meet in pairs
    dealt = members.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int")
    placed = members.join(dealt, "hub").withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    placed = placed.select("node", "hub", "chunk", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"))
    sketched = placed.join(classes.select("node", "doc_id", "text_hash", "n", "registers"), "node").select("hub", "one", "two", "chunk", "doc_id", "text_hash", "n", "registers")
    hopeful = _grouped(sketched, parts).mapInArrow(_hopeful, "hub long, one int, two int, chunk int, doc_id long, text_hash long")
    hopeful = stage(hopeful, "hopeful")

    texts = docs.select(F.col("doc_id").cast("long"), "text").withColumn("text_hash", F.xxhash64("text"))
    wanted = hopeful.select("doc_id", "text_hash").distinct()
    # Wanted ids grow with the corpus, so both sides are shuffled at any size. A repeated row would be its
    # own partner.
    texts = texts.join(wanted.hint("merge"), ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
    compared = hopeful.join(texts, ["doc_id", "text_hash"]).select("hub", "one", "two", "chunk", "doc_id", "text")
    links = _grouped(compared, parts).mapInArrow(_verify, "a long, b long")

    named = rows.join(classes.select("c1", "c2", F.col("doc_id").alias("copy_of")), ["c1", "c2"], "left")
    named = named.withColumn("copy_of", F.when(F.col("doc_id").isNotNull(), F.coalesce("copy_of", "doc_id")))
    # rows of one id that stand in several classes tie these together
    pairs = named.where("n > 0").select("doc_id", "copy_of").where("copy_of IS NOT NULL").distinct()
    several = pairs.groupBy("doc_id").agg(F.count("*").alias("classes")).where("classes > 1").select("doc_id")
    several = pairs.join(several, "doc_id").select(F.col("copy_of").alias("a"), F.col("doc_id").alias("b"))
    found = components(links.unionAll(several))
    out = named.join(found, F.col("copy_of") == F.col("node"), "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "copy_of")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
