"""Collocations: phrases of two or three words that occur together more than their parts do.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into words at blanks and tabs. Per
language, n counts words, f(phrase) its occurrences within pieces, overlaps included. A phrase with a = f(phrase) of
LEAST or more is a candidate. Cut after its first words, with l and r the counts of both parts, it scores
floor(1000000 a a / (l r)); the lowest-scoring cut counts. A candidate is dropped when a longer candidate around it,
dropped or not, has half its count or more. Each language's first ``top`` of the rest are returned.

Phrases grow best first. Words are counted, then pairs of words that are frequent enough. A pair's count over that of
its first word, f(w1 w2) / f(w1), bounds the score of every longer phrase that it begins: a <= f(w1 w2), and the count
of the rest is a or more. The frontier is the pairs by falling bound. A round takes a level per language and expands
all pairs whose bound reaches it, to the right, and all whose own score reaches it, to the left too, in one pass over
the texts: the count of no longer phrase on or above the level, and of none that could drop a pair on it, is then
missing, so every phrase with a score on or above the level is settled. A language is done when ``top`` phrases on or
above its level survive (those that tie with the last one are on it as well), or when its level is 0; else its level
falls, and only the pairs between both levels are expanded.

Which pairs a pass counts is looked up in bit tables of a fixed size, broadcast to the tasks: a bit that two keys share
lets more phrases be counted, exactly, and none fewer. Phrases are added up by their text, scores by decimal
arithmetic (38 digits: exact for counts below 10**16).

Null and empty texts have no words. A null language is ``und``. Repeated rows count as often as they stand. A null
doc_id does not matter, since ids are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stage
from tidemark.llm.words import SPACES, Words, mix, slices, words_of

_U = np.uint64

#: Phrases per language that are returned, and their least count.
TOP, LEAST = 2000, 10
#: A longer phrase with this share of a count, in hundredths, takes the place of the shorter one.
COVERED = 50
MILLION = 1_000_000
#: log2 of the bits of a lookup table: 8 MB each.
BITS = 26
#: Bytes of text handled at once, and distinct pairs a task adds up before it sends them.
SLICE, HELD = 2 << 20, 1 << 21
#: The first level is one that so many times ``top`` pairs reach; each later one takes more pairs by that factor.
FIRST, FURTHER = 2, 4

BREAKS = np.zeros(256, bool)
BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
APART = BREAKS | SPACES


class Texts:
    """Words of some rows: their keys (with the language folded in) and which follow one another in a piece."""

    def __init__(self, part: pa.RecordBatch):
        self.words: Words = words_of(part.column("text"), lower=True, apart=APART)
        langs = part.column("lang").dictionary_encode()
        self.names, self.of_doc = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)
        salt = np.array([_salt(x) for x in self.names.to_pylist()], _U)
        doc = self.words.doc
        self.keys = mix(self.words.hashes() ^ salt[self.of_doc][doc]) if len(doc) else np.empty(0, _U)
        breaks = np.append(0, np.cumsum(BREAKS[self.words.data], dtype=np.int64))
        self.follows = (np.diff(doc) == 0) & (breaks[self.words.start[1:]] == breaks[self.words.end[:-1]])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and key of each pair."""
        at = np.flatnonzero(self.follows)
        return at, mix(self.keys[at] * _U(0x9E3779B97F4A7C15) + self.keys[at + 1])

    def lang(self, at: np.ndarray) -> pa.Array:
        return self.names.take(pa.array(self.of_doc[self.words.doc[at]]))

    def texts(self, at: np.ndarray) -> pa.Array:
        start, size = self.words.start[at], self.words.end[at] - self.words.start[at]
        ends = np.cumsum(size)
        index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
        offsets = np.append(0, ends).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.words.data[index]))


_salts: dict[str, int] = {}


def _salt(lang: str) -> int:
    if lang not in _salts:
        if len(_salts) > 100_000:
            _salts.clear()
        _salts[lang] = int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")
    return _salts[lang]


def _holds(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & _U((len(table) << 6) - 1)
    return (table[(at >> _U(6)).astype(np.int64)] >> (at & _U(63)) & _U(1)).astype(bool)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Texts]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            yield Texts(part)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, w, key, n) of some rows; w is null for all words of a language."""
    for t in _parts(batches):
        keys, first, n = np.unique(t.keys, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([t.lang(first), t.texts(first), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "w", "key", "n"])
        all_words = np.bincount(t.of_doc[t.words.doc], minlength=len(t.names))
        none = pa.nulls(len(t.names), pa.string())
        yield pa.RecordBatch.from_arrays([t.names, none, pa.array(np.zeros(len(t.names), np.int64)), pa.array(all_words)], ["lang", "w", "key", "n"])


def _count_pair_keys(batches: Iterator[pa.RecordBatch], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, n) of pairs of frequent words, added up over the rows of a task as far as memory goes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for t in _parts(batches):
        frequent = _holds(words, t.keys)
        at, keys = t.pairs()
        held.append(np.unique(keys[frequent[at] & frequent[at + 1]], return_counts=True))
        size += len(held[-1][0])
        if size > HELD:
            held = [_summed(held)]
            size = len(held[0][0])
            if size > HELD // 2:
                yield _keyed(*held[0])
                held, size = [], 0
    if held:
        yield _keyed(*_summed(held))


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, np.diff(keys) != 0)[: len(keys)])
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _keyed(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])


def _count_pairs(batches: Iterator[pa.RecordBatch], pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lang, w1, w2, key, n) of the pairs in a table."""
    for t in _parts(batches):
        at, keys = t.pairs()
        some = _holds(pairs, keys)
        keys, first, n = np.unique(keys[some], return_index=True, return_counts=True)
        at = at[some][first]
        columns = [t.lang(at), t.texts(at), t.texts(at + 1), pa.array(keys.view(np.int64)), pa.array(n)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "w1", "w2", "key", "n"])


def _count_triples(batches: Iterator[pa.RecordBatch], pairs: np.ndarray, right: np.ndarray, left: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lang, w1, w2, w3, n) of phrases of two pairs in a table that begin with one to be grown to the right or end with one to
    be grown to the left."""
    for t in _parts(batches):
        at, keys = t.pairs()
        both = np.flatnonzero(np.diff(at) == 1)
        head, tail = keys[both], keys[both + 1]
        some = _holds(pairs, head) & _holds(pairs, tail) & (_holds(right, head) | _holds(left, tail))
        at, head, tail = at[both][some], head[some], tail[some]
        _, first, n = np.unique(mix(head * _U(0xD1342543DE82EF95) + tail), return_index=True, return_counts=True)
        at = at[first]
        columns = [t.lang(at), t.texts(at), t.texts(at + 1), t.texts(at + 2), pa.array(n)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "w1", "w2", "w3", "n"])


class _Table:
    """A set of keys as bits, built by Spark and sent to every task."""

    def __init__(self, keys: DataFrame, bits: int = BITS):
        place = F.pmod(F.col("key"), F.lit(1 << bits))
        words = keys.select(F.shiftright(place, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col("key"), F.lit(64)).cast("int")).alias("bit"))
        rows = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2**(bits - 6) rows
        table = np.zeros(1 << bits - 6, _U)
        table[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(_U)
        self.sent = keys.sparkSession.sparkContext.broadcast(table)

    @property
    def value(self) -> np.ndarray:
        return self.sent.value

    def drop(self) -> None:
        self.sent.unpersist()


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact."""
    wide = [x.cast("decimal(38,0)") for x in (a, left, right)]
    return F.call_function("div", F.lit(MILLION).cast("decimal(38,0)") * wide[0] * wide[0], wide[1] * wide[2])


class Miner:
    """Counts of a corpus that have been found so far."""

    def __init__(self, docs: DataFrame, top: int = TOP, least: int = LEAST, bits: int = BITS):
        ship(docs.sparkSession)
        self.top, self.least, self.bits = top, least, bits
        self.rows = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
        counts = self._pass(_count_words, "lang string, w string, key long, n long").groupBy("lang", "w", "key").agg(F.sum("n").alias("n"))
        counts = stage(counts.where(F.col("w").isNull() | (F.col("n") >= least)), "words")
        self.totals = counts.where("w IS NULL").select("lang", F.col("n").alias("total"))
        self.words = counts.where("w IS NOT NULL").select("lang", "w", "key", "n")
        self.frequent, self.pairs = self._count_pairs()
        self.triples: DataFrame | None = None

    def _pass(self, count: Callable, schema: str, *tables: _Table) -> DataFrame:
        sent = [t.sent for t in tables]
        return self.rows.mapInArrow(lambda batches: count(batches, *(x.value for x in sent)), schema)

    def _frequent(self, rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("n").alias("n")).where(F.col("n") >= self.least)

    def _count_pairs(self) -> tuple[_Table, DataFrame]:
        """All frequent pairs with the counts of their words, score, and the bound of what they begin."""
        words = _Table(self.words, self.bits)
        keys = self._frequent(self._pass(_count_pair_keys, "key long, n long", words), "key")
        table = _Table(keys, self.bits)
        words.drop()
        found = self._pass(_count_pairs, "lang string, w1 string, w2 string, key long, n long", table)
        pairs = self._frequent(found, "lang", "w1", "w2", "key")
        for k in "12":
            pairs = pairs.join(self.words.select("lang", F.col("w").alias(f"w{k}"), F.col("n").alias(f"n{k}")), ["lang", f"w{k}"])
        n = F.col("n")
        bound = F.call_function("div", F.lit(MILLION).cast("decimal(38,0)") * n.cast("decimal(38,0)"), F.col("n1").cast("decimal(38,0)"))
        return table, stage(pairs.select("*", score(n, F.col("n1"), F.col("n2")).alias("score"), bound.alias("bound")), "pairs")

    def level(self, times: int) -> DataFrame:
        """(lang, level): the highest score that ``times * top`` pairs of a language reach, 0 if no score is."""
        reached = self.pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))  # a million rows a language at most
        above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))
        enough = F.max(F.when(F.col("above") >= times * self.top, F.col("score")))
        return reached.select("*", above.alias("above")).groupBy("lang").agg(F.coalesce(enough, F.lit(0)).alias("level"))

    def expand(self, levels: DataFrame) -> None:
        """Counts the phrases of three words that pairs with a bound of ``level`` or more (and below ``before``) begin,
        and those that pairs with such a score end."""
        reach = self.pairs.join(levels, "lang")
        between = lambda x: (F.col(x) >= F.col("level")) & (F.col("before").isNull() | (F.col(x) < F.col("before")))
        tables = [self.frequent, *(_Table(reach.where(between(x)).select("key"), self.bits) for x in ("bound", "score"))]
        found = self._frequent(self._pass(_count_triples, "lang string, w1 string, w2 string, w3 string, n long", *tables), "lang", "w1", "w2", "w3")
        if self.triples is not None:  # one that was met again has the same count
            found = found.unionByName(self.triples).distinct()
        self.triples = stage(found, "triples")
        for t in tables[1:]:
            t.drop()

    def survivors(self, levels: DataFrame) -> DataFrame:
        """(lang, phrase, a, l, r, score) of all phrases with a score on or above their language's level that stay."""
        t = self.triples
        pair = lambda x, y: F.struct(F.col(x).alias("w1"), F.col(y).alias("w2"))
        longer = t.select("lang", "n", F.explode(F.array(pair("w1", "w2"), pair("w2", "w3"))).alias("p"))
        longer = longer.groupBy("lang", "p.w1", "p.w2").agg(F.max("n").alias("longer"))
        twos = self.pairs.join(longer, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("n")))
        twos = twos.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), F.col("n1").alias("l"), F.col("n2").alias("r"), "score")
        one = lambda k: self.words.select("lang", F.col("w").alias(f"w{k}"), F.col("n").alias(f"n{k}"))
        two = lambda j, k: self.pairs.select("lang", F.col("w1").alias(f"w{j}"), F.col("w2").alias(f"w{k}"), F.col("n").alias(f"n{j}{k}"))
        t = t.join(two(1, 2), ["lang", "w1", "w2"]).join(two(2, 3), ["lang", "w2", "w3"]).join(one(1), ["lang", "w1"]).join(one(3), ["lang", "w3"])
        a = F.col("n")
        cuts = [F.struct(score(a, F.col(x), F.col(y)).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for k, x, y in ((1, "n1", "n23"), (2, "n12", "n3"))]
        threes = t.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), a.alias("a"), F.least(*cuts).alias("cut"))
        threes = threes.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        return twos.unionByName(threes).join(levels, "lang").where(F.col("score") >= F.col("level")).drop("level", "before")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, first: int = FIRST, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases by falling score, falling a, and phrase.

    ``first``, in multiples of ``top``, sets the level of the first round and with it the number of rounds, not the result.
    """
    miner = Miner(docs, top, least, bits)
    levels = stage(miner.level(first).withColumn("before", F.lit(None).cast("bigint")), "levels")
    miner.expand(levels)
    reached, times = levels, first
    while True:
        found = stage(miner.survivors(reached), "survivors")
        counts = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        short = reached.join(counts, "lang", "left").where("level > 0 AND coalesce(n, 0) < %d" % top).select("lang", F.col("level").alias("before"))
        short = stage(short, "short")
        if short.isEmpty():
            break
        times *= FURTHER
        lower = stage(miner.level(times).join(short, "lang"), "levels")
        miner.expand(lower)
        reached = stage(reached.join(lower.select("lang", F.col("level").alias("lower")), "lang", "left").select("lang", F.coalesce("lower", "level").alias("level"), "before"), "reached")
    # first within pieces of a language, then over what is left of each, so that no task sorts a language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    piece = F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("piece")
    some = found.select("*", piece).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "piece").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(miner.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
