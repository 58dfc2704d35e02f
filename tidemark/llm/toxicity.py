"""Toxic passages by maximum-scoring segments, and a document's probability to be toxic.

1. Tokens are words and their beginnings of 5 to 8 bytes, which inflected words share. Numbers of labelled
   documents that hold a token, toxic and not, give it log-odds with an informative Dirichlet prior: the
   prior expects a token as often as all labelled documents together have it and is worth a quarter as
   many documents as are toxic. Tokens that lean to toxic text by three standard errors or more, and by
   ``LEAST_ODDS`` at the lower end of their log-odds, are listed with that lower end. A word scores as the highest of its listed tokens; all others count against a passage.
2. A linear-time scan (Ruzzo and Tompa) finds all maximal segments of a text: passages whose total cannot
   be raised by growing or shrinking. Listed words are few, so the scan steps from one to the next.
3. Scores of the best segments of random text follow an extreme-value law with a decay that the words'
   frequencies determine and a scale fitted to the clean labelled documents. It turns a segment's
   score and the text's length into an expected number of such passages by chance; passages below
   ``SIGNIFICANT`` are reported.
4. A document's evidence is the sum over its significant passages; labelled documents are counted by
   evidence, and a logistic curve through these counts gives the probability.

Tokens are learned from three quarters of the labels, law and curve from the rest, lest tokens that a few
toxic copies share look surer than they are.

Words are runs of 0-9, a-z (A-Z made small) and non-ASCII characters. Null and wordless texts have no
passages and the probability of the least evidence. Labels that are null, or on rows without an id,
teach nothing; of several labels of one id the largest counts. Without labels of both kinds no
word is listed and every probability is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stage
from tidemark.llm.words import _BASE_2, NOT_ALNUM, Words, prints, slices, words_of

#: Labelled documents of either kind that words are learned from at most, chosen by a hash of their id.
SAMPLE = 200_000
#: Standard errors by which a listed word leans to toxic text, and documents it has to occur in.
LEAN, LEAST_DOCS = 3.0, 3
#: Log-odds that the lower end of a listed token's has to reach: lesser leanings add up in long clean texts. This and PRIOR
#: were chosen on a part of the learning rows that was left out for that (crc32 of the id modulo 5 is 1).
LEAST_ODDS = 2.0
#: Documents the prior is worth, as a share of the toxic ones.
PRIOR = 0.25
#: Lengths in bytes of the beginnings of words that are tokens of their own.
BEGINNINGS = (5, 6, 7, 8)
#: Expected number of chance passages below which one is significant.
SIGNIFICANT = 0.05
#: Bins of evidence in which labelled documents are counted, and its value from which they share the last one.
BINS, TOP = 200, 40.0

SEGMENTS = "array<struct<start:int, n_words:int, score:double>>"


@dataclass
class Model:
    """Listed words (fingerprints, ascending) and scores; what any other word costs; the law of chance."""

    words: np.ndarray
    scores: np.ndarray
    step: float = 1.0
    decay: float = 1.0
    scale: float = 1.0
    slope: float = 0.0
    level: float = -np.inf


def _tokens(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints of all words, then of their beginnings, with the places of the words they are of."""
    out = [(np.arange(len(words.start)), words.hashes())]
    size = words.end - words.start
    for k in BEGINNINGS:
        some = np.flatnonzero(size >= k)
        out.append((some, prints(words.data, words.start[some], words.start[some] + k, _BASE_2)))
    return out


def _hits(part: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; text, place and score of each word with a listed token."""
    words = words_of(part.column("text"), lower=True, apart=NOT_ALNUM)
    if not len(model.words) or not len(words.start):
        return words.counts, *(np.empty(0, np.int64),) * 2, np.empty(0)
    best = np.zeros(len(words.start))
    for place, token in _tokens(words):
        at = np.minimum(np.searchsorted(model.words, token), len(model.words) - 1)
        found = np.flatnonzero(model.words[at] == token)
        best[place[found]] = np.maximum(best[place[found]], model.scores[at[found]])
    found = np.flatnonzero(best)
    doc = words.doc[found]
    return words.counts, doc, found - words.first[doc], best[found]


def segments(place: np.ndarray, score: np.ndarray, step: float) -> list[tuple[int, int, float]]:
    """All maximal segments (first place, last place, score) of a text whose listed words stand at ``place``;
    each other word costs ``step``. Linear in the listed words."""
    held: list[list] = []  # first, last, total before, total after, index of the one to its left with a smaller total before
    total, last = 0.0, -1
    for p, s in zip(place.tolist(), score.tolist(), strict=True):
        total -= step * (p - last - 1)
        now = [p, p, total, total + s, -1]
        last, total = p, total + s
        while True:
            left = len(held) - 1
            while left >= 0 and held[left][2] >= now[2]:
                left = held[left][4]
            now[4] = left
            if left < 0 or held[left][3] >= now[3]:
                held.append(now)
                break
            now = [held[left][0], now[1], held[left][2], now[3], -1]
            del held[left:]
    return [(a, b, after - before) for a, b, before, after, _ in held]


def _scan(batches: Iterator[pa.RecordBatch], model: Model, keep: list[str]) -> Iterator[pa.RecordBatch]:
    """``keep``, number of words, best score and all maximal segments of each text."""
    for batch in batches:
        for part in slices(batch, "text"):
            counts, doc, place, score = _hits(part, model)
            best = np.zeros(len(part))
            found: list[list] = [[] for _ in range(len(part))]
            edges = np.flatnonzero(np.diff(doc, prepend=-1, append=len(part)))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                runs = segments(place[i:j], score[i:j], model.step)
                best[doc[i]] = max(s for _, _, s in runs)
                found[doc[i]] = [{"start": a, "n_words": b - a + 1, "score": s} for a, b, s in runs]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(x) for x in keep), pa.array(counts), pa.array(best), pa.array(found, _SEGMENTS)],
                [*keep, "n_words", "best", "segments"],
            )


_SEGMENTS = pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("score", pa.float64())]))


COUNTS = ("toxic", "clean", "times")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's texts: toxic and other ones that hold each token, and times it occurs in the other ones;
    for the null word, number and words of the other ones."""
    held: list[np.ndarray] = []
    size = texts = total = 0
    for batch in batches:
        for part in slices(batch, "text"):
            words = words_of(part.column("text"), lower=True, apart=NOT_ALNUM)
            label = part.column("toxic").to_numpy() == 1
            texts, total = texts + int((~label).sum()), total + int(words.counts[~label].sum())
            for place, token in _tokens(words):
                if not len(token):
                    continue
                doc = words.doc[place]
                order = np.lexsort((doc, token))
                token, doc = token[order].view(np.int64), doc[order]
                first = np.flatnonzero(np.append(True, np.diff(token) != 0))
                once = np.append(True, (np.diff(token) != 0) | (np.diff(doc) != 0))
                rows = np.zeros(len(first), [("word", "<i8")] + [(x, "<i8") for x in COUNTS])
                rows["word"] = token[first]
                for name, x in (("toxic", once & label[doc]), ("clean", once & ~label[doc]), ("times", ~label[doc])):
                    rows[name] = np.add.reduceat(x.astype(np.int64), first)
                held.append(rows)
                size += len(rows)
            if size > 1_500_000:
                held = [_summed(held)]
                size = len(held[0])
                if size > 750_000:
                    yield _rows(held[0])
                    held, size = [], 0
    if held:
        yield _rows(_summed(held))
    if texts:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (None, 0, texts, total)], ["word", *COUNTS])


def _summed(held: list[np.ndarray]) -> np.ndarray:
    rows = np.concatenate(held)
    rows = rows[np.argsort(rows["word"], kind="stable")]
    first = np.flatnonzero(np.append(True, np.diff(rows["word"]) != 0))
    out = rows[first].copy()
    for name in COUNTS:
        out[name] = np.add.reduceat(rows[name], first)
    return out


def _rows(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[x])) for x in ("word", *COUNTS)], ["word", *COUNTS])


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of usable labels, one per id."""
    rows = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    return rows.groupBy(F.col("doc_id").cast("long")).agg(F.max("toxic").alias("toxic"))


def learn_words(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Listed words and the law of chance from at most ``sample`` labelled documents of either kind."""
    ship(docs.sparkSession)
    usable = labelled(labels)
    sizes = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = Model(np.empty(0, np.uint64), np.empty(0))
    if len(sizes) < 2:
        return none
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.when(F.col("toxic") == 1, F.lit(sample / sizes[1])).otherwise(F.lit(sample / sizes[0]))
    # ``sample`` of either kind as far as a hash can tell, so this list is bounded and may be broadcast
    chosen = usable.where(draw < share * (1 << 30))
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    counts = rows.mapInArrow(_count, "word long, toxic long, clean long, times long").groupBy("word").agg(*[F.sum(x).alias(x) for x in COUNTS])
    toxic, clean = (float(min(sample, sizes[k])) for k in (1, 0))
    prior = F.lit(PRIOR * toxic) * (F.col("toxic") + F.col("clean")) / F.lit(toxic + clean)
    odds = lambda x, n: F.log((x + prior) / F.greatest(F.lit(1.0), F.lit(n + PRIOR * toxic) - x - prior))
    every = F.col("word").isNull()
    table = counts.where((F.col("toxic") >= LEAST_DOCS) | every).withColumn("odds", odds(F.col("toxic"), toxic) - odds(F.col("clean"), clean))
    table = table.withColumn("error", F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)))
    table = table.where(((F.col("odds") >= LEAN * F.col("error")) & (F.col("odds") - F.col("error") >= LEAST_ODDS)) | every)
    # the sample and LEAST_DOCS bound their number
    best = table.collect()
    n_words = sum(r["times"] for r in best if r["word"] is None)
    best = [r for r in best if r["word"] is not None]
    if not best or not n_words:
        return none
    word = np.array([r["word"] for r in best], np.int64).view(np.uint64)
    score = np.array([r["odds"] - r["error"] for r in best])
    # how often a word of clean text is listed
    often = np.array([r["times"] + 0.5 for r in best]) / (n_words + 0.5 * len(best))
    order = np.argsort(word)
    # An unlisted word costs as much as makes clean text lose twice what its listed words bring.
    step = float(max(0.05, 2 * (often * score).sum()))
    return Model(word[order], score[order], step, _decay(score, often, step))


def _decay(score: np.ndarray, often: np.ndarray, step: float) -> float:
    """The positive solution of: the mean of exp(decay * score of a word of clean text) is 1."""
    rest = max(1e-9, 1 - often.sum())
    low, high = 0.0, 1.0
    mean = lambda x: (often * np.exp(x * score)).sum() + rest * np.exp(-x * step)
    while mean(high) < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def scan(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """doc_id, ``keep``, n_words, best and segments of each row."""
    names = ["doc_id", *keep]
    rows = docs.select(F.col("doc_id").cast("long"), *keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names)
    return rows.mapInArrow(lambda it: _scan(it, model, names), f"{schema}, n_words long, best double, segments {SEGMENTS}")


def fit_chance(scanned: DataFrame, labels: DataFrame, model: Model) -> Model:
    """Sets the scale of the extreme-value law: its maximum-likelihood estimate over the clean documents."""
    clean = scanned.join(labelled(labels).where("toxic = 0"), "doc_id").where("n_words > 0")
    n, mass = clean.agg(F.count("*"), F.sum(F.col("n_words") * F.exp(-F.lit(model.decay) * F.col("best")))).first()
    model.scale = float(n / mass) if n else 1.0
    return model


def with_evidence(scanned: DataFrame, model: Model) -> DataFrame:
    """Adds the significant passages (start, n_words, score, expected) and their evidence."""
    expected = f"{model.scale!r}D * n_words * exp(-{model.decay!r}D * s.score)"
    passages = f"filter(transform(segments, s -> struct(s.start AS start, s.n_words AS n_words, s.score AS score, {expected} AS expected)), s -> s.expected < {SIGNIFICANT})"
    rows = scanned.withColumn("passages", F.expr(passages)).drop("segments")
    # the logarithm of ``expected`` taken apart, since that is 0 in double precision for very high scores
    evidence = f"aggregate(passages, 0D, (a, s) -> a + {model.decay!r}D * s.score - ln({model.scale!r}D * n_words))"
    return rows.withColumn("evidence", F.expr(evidence))


def fit_curve(rows: DataFrame, labels: DataFrame, model: Model) -> Model:
    """Fits the logistic curve to numbers of labelled documents by evidence."""
    seen = F.least(F.col("evidence"), F.lit(TOP))
    place = F.floor(seen * (BINS / TOP)).cast("int")
    table = rows.join(labelled(labels), "doc_id").groupBy(place.alias("bin"), "toxic").agg(F.count("*").alias("n"), F.sum(seen).alias("sum")).collect()
    if len({r["toxic"] for r in table}) < 2:
        return model
    x = np.array([r["sum"] / r["n"] for r in table])
    y, n = np.array([r["toxic"] for r in table], float), np.array([r["n"] for r in table], float)
    design = np.stack([np.ones_like(x), x], axis=1)
    weight = np.array([np.log((n[y == 1].sum() + 1) / (n[y == 0].sum() + 1)), 0.0])
    ridge = np.diag([1e-6, 1e-2])  # keeps the maximum finite
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weight, -30, 30)))
        slope = design.T @ (n * (y - p)) - ridge @ weight
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + ridge, slope)
        weight = weight + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    model.level, model.slope = float(weight[0]), float(max(0.0, weight[1]))
    return model


def score(docs: DataFrame, labels: DataFrame, *keep: str) -> tuple[DataFrame, Model]:
    """Per row of ``docs``: doc_id, ``keep``, n_words, best, passages, evidence and score, with words, law and
    curve learned from ``labels``; and the model."""
    rest = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(4)) == 0
    model, labels = learn_words(docs, labels.where(~rest)), labels.where(rest)
    scanned = stage(scan(docs, model, *keep), "scanned")
    rows = with_evidence(scanned, fit_chance(scanned, labels, model))
    model = fit_curve(rows, labels, model)
    if not np.isfinite(model.level):
        return rows.withColumn("score", F.lit(0.0)), model
    power = F.lit(model.level) + F.lit(model.slope) * F.col("evidence")
    return rows.withColumn("score", 1 / (1 + F.exp(-power))), model
