"""Quality rules whose cutoffs limit how many good documents they reject, all of them together.

Everything here is DataFrame and SQL functions. A rule rejects documents whose measure lies above a cutoff
(or, for lengths of words, below). Cutoffs are chosen on labelled documents, separately in each stratum of text
lengths, in two halves. On the first half, each of STEPS + 1 sets of cutoffs is laid down: a set holds, for every rule, the
strictest cutoff that rejects at most ``share`` / 2**step of the good documents there, and the last one none. On the
second half, which had no say in them, it is counted how many good documents each *whole set* rejects, by one rule or
several. A set is admissible if the exact binomial bound on the share of all good documents it rejects is at most
``share``. The bounds of all sets and strata hold together with probability 1 - ``risk``, each being taken at ``risk`` divided
by their number (Bonferroni). The strictest admissible set is used; where none is, for lack of labels, the rules reject
nothing.

The labels count only here; measures never look at them. What is gathered is one count for each stratum,
rule and measure and one for each stratum and set, a fixed number. Null texts have no words and fail the base rules. Null
and repeated labels: a document is good if all its non-null labels say so. A document without an id is judged like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CHARS, ship, stage
from tidemark.llm.decontam import shingles, words

SYMBOLS = "#*$%&|<>"
#: Lengths in words at which a new stratum begins.
STRATA = (100, 300, 1000)
#: Rules and the number of their cutoffs: measures are whole numbers from 0 to that.
RULES = {"symbols": 100, "dup_lines": 100, "repeats": 100, "long_words": 200, "short_words": 200}
SHARE, RISK = 0.01, 0.05
#: Repeated windows up to which each window is looked up in a list of them; beyond, windows are sorted.
LISTED = 32

#: Sets of cutoffs besides the one that rejects no good document of the first half.
STEPS = 8
TESTS = (len(STRATA) + 1) * (STEPS + 1)
#: Documents of the first half; the others are the second.
FIRST_HALF = "substr(md5(CAST(CAST(doc_id AS STRING) AS BINARY)), 1, 1) < '8'"


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of each row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.length(F.translate(text, SPACE_CHARS, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACE_CHARS, "")) > 0).alias("lines"),
        words(F.col("text")).alias("w"),
    )
    rows = rows.withColumn("windows", shingles(3)).withColumn("sorted", F.sort_array("windows"))
    rows = rows.withColumn("twice", F.expr("array_distinct(filter(sorted, (x, i) -> i > 0 AND x = get(sorted, i - 1)))"))
    # places of repeated windows in ascending order
    listed = "filter(sequence(0, size(windows) - 1), i -> array_contains(twice, windows[i]))"
    ordered = "array_sort(transform(windows, (x, i) -> struct(x AS x, i AS i)))"
    rows = rows.withColumn("ordered", F.expr(f"CASE WHEN size(twice) > {LISTED} THEN {ordered} END"))
    long_ = "array_sort(transform(filter(ordered, (s, k) -> s.x = get(ordered, k - 1).x OR s.x = get(ordered, k + 1).x), s -> s.i))"
    rows = rows.withColumn("places", F.expr(f"CASE WHEN size(twice) = 0 THEN CAST(array() AS array<int>) WHEN size(twice) <= {LISTED} THEN {listed} ELSE {long_} END"))
    covered = "aggregate(transform(places, (x, k) -> least(3, coalesce(get(places, k + 1), x + 3) - x)), 0, (a, x) -> a + x)"
    return rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.col("word_chars").cast("long"),
        F.col("n_symbols").cast("long"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _scored(rows: DataFrame) -> DataFrame:
    """Adds base_failed, the stratum, and the measure of each rule as a whole number."""
    stratum = sum(((F.col("n_words") >= n).cast("int") for n in STRATA[1:]), (F.col("n_words") >= STRATA[0]).cast("int"))
    length = "10 * word_chars DIV greatest(1, n_words)"
    return rows.withColumns(
        {
            "base_failed": F.expr(BASE_FAILED),
            "stratum": stratum,
            "symbols": F.expr("least(100, 100 * n_symbols DIV greatest(1, word_chars))"),
            "dup_lines": F.expr("100 * n_dup_lines DIV greatest(1, n_lines)"),
            "repeats": F.expr("100 * n_repeat_words DIV greatest(1, n_words)"),
            "long_words": F.expr(f"least(200, {length})"),
            "short_words": F.expr(f"200 - least(200, {length})"),
        }
    )


def admissible(rejected: int, n: int, share: float, level: float) -> bool:
    """Does seeing ``rejected`` of n bound the true share by ``share``? True if so few would be seen with a
    probability of at most ``level`` were the share as large (exact binomial)."""
    if rejected >= n * share:
        return False
    log = math.lgamma(n + 1) - math.lgamma(rejected + 1) - math.lgamma(n - rejected + 1) + rejected * math.log(share) + (n - rejected) * math.log1p(-share)
    term = total = 1.0
    for i in range(rejected, 0, -1):  # the terms below, each as a part of the last one
        term *= i * (1 - share) / ((n - i + 1) * share)
        total += term
        if term < 1e-18 * total:
            break
    return log + math.log(total) <= math.log(level)


def laid_down(counts: list, share: float) -> dict[tuple[int, int], dict[str, int]]:
    """By stratum and step: the cutoff of each rule, from (stratum, rule, value, rejected, n) of the first half."""
    sets: dict[tuple[int, int], dict[str, int]] = {}
    for row in sorted(counts, key=lambda r: -r["value"]):
        # a cutoff between two measures that occur rejects what the lower one does
        for step in range(STEPS + 1):
            if row["rejected"] <= (share / 2**step if step < STEPS else 0) * row["n"]:
                sets.setdefault((row["stratum"], step), {})[row["rule"]] = row["value"]
    return sets


def cutoffs(scored: DataFrame, labels: DataFrame, share: float = SHARE, risk: float = RISK) -> dict[tuple[int, str], int]:
    """By stratum and rule: the measure above which documents are rejected."""
    good = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = scored.where("NOT base_failed").join(good, "doc_id", "left_semi").select("stratum", *RULES, F.expr(FIRST_HALF).alias("first"))
    measured = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).cast("int").alias("value")) for r in RULES]))
    counts = held.where("first").select("stratum", measured.alias("m")).groupBy("stratum", "m.rule", "m.value").agg(F.count("*").alias("n"))
    every = Window.partitionBy("stratum", "rule")
    above = every.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    table = counts.select("stratum", "rule", "value", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("rejected"), F.sum("n").over(every).alias("n"))
    sets = laid_down(table.collect(), share)
    if not sets:
        return {}
    rejects = {k: " OR ".join(f"{rule} > {value}" for rule, value in of.items()) for k, of in sets.items()}
    union = [F.count_if(F.expr(f"stratum = {s} AND ({rejects[s, step]})")).alias(f"r{s}_{step}") for s, step in sets]
    sizes = [F.count_if(F.col("stratum") == s).alias(f"n{s}") for s in {s for s, _ in sets}]
    seen = held.where("NOT first").agg(*union, *sizes).first()
    chosen: dict[int, int] = {}
    for s, step in sorted(sets, reverse=True):
        if admissible(seen[f"r{s}_{step}"], seen[f"n{s}"], share, risk / TESTS):
            chosen[s] = step
    return {(s, rule): value for s, step in chosen.items() for rule, value in sets[s, step].items()}


def judge(docs: DataFrame, labels: DataFrame, share: float = SHARE, risk: float = RISK) -> DataFrame:
    """Per row of ``docs``: its measures, base_failed, kept, and the rules that reject it."""
    ship(docs.sparkSession)
    scored = stage(_scored(measures(docs)), "measures")
    chosen = cutoffs(scored, labels, share, risk)
    fails = [F.when((F.col("stratum") == s) & (F.col(rule) > value), F.lit(rule)) for (s, rule), value in sorted(chosen.items())]
    rejected = F.array_compact(F.array(*fails)) if fails else F.array().cast("array<string>")
    rows = scored.withColumn("rejected_by", rejected)
    kept = ~F.col("base_failed") & (F.size("rejected_by") == 0)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.concat_ws(",", "rejected_by").alias("rejected_by"))
