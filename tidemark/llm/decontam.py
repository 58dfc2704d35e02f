"""Documents that hold benchmark items, found with SimHash windows and multi-index blocks.

Everything here is DataFrame and SQL functions. Words are runs between ASCII white space, in lower case;
a text's shingles are its runs of five words, each as often as it occurs.

1. Shingles of all documents are looked up among those of the items. Each shared shingle lines the item up
   with the document and gives the window of the item's length there, moved inside the document where it
   would stick out. An item edited in several places is lined up in several ways, and the window between
   two of them may be the best one, so the windows of all starts between neighbouring ones are taken too.
   Outside of these a window has no more in common with the item than the nearest lined-up one; windows
   that have fewer shared shingles than the threshold needs are left out (see ``spots_of``).
2. Each of these item-sized windows gets a 64-bit SimHash of its shingles, as often as they occur. Fingerprints of
   windows and items are cut into RADIUS + 1 blocks; two that differ in at most RADIUS bits agree in
   some block, so equal blocks find every pair within the radius, and a bit count drops the others. At
   the similarity 0.75 fingerprints differ in 11 bits on average with a deviation of 3, so the radius
   of 23 lies four deviations off.
3. A pair is verified exactly: the sum of the smaller counts of each shingle against that of the larger
   ones (weighted Jaccard similarity), 0.75 or more.

Items shorter than a shingle match nothing. Null and short texts hold nothing. A row without an id is
reported with a null id. Repeated rows and equal items are each reported once per id and item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, SPACE_CHARS, ship, stage

SHINGLE = 5
RADIUS = 23
BITS = 64
#: Length of the longest cycle of words whose equal windows are told apart.
PERIOD = 4
#: Item shingles up to which their table is broadcast (16 bytes each); beyond, both sides are shuffled.
BROADCAST = 2_000_000


def words(text: Column) -> Column:
    """Words of a text; none for null."""
    inside = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.length(inside) > 0, F.split(inside, f"[{SPACE}]+")).otherwise(F.array().cast("array<string>"))


def shingles(size: int = SHINGLE, column: str = "w") -> Column:
    """Fingerprints of each ``size`` words in a row of the column of words."""
    row = ", ".join(f"{column}[i + {k}]" for k in range(size))
    return F.expr(f"CASE WHEN size({column}) >= {size} THEN transform(sequence(0, size({column}) - {size}), i -> xxhash64({row})) ELSE CAST(array() AS array<bigint>) END")


def simhash(df: DataFrame, source: str, name: str) -> DataFrame:
    """Adds the SimHash of an array of fingerprints, each bit the majority of its elements.

    Counts of 64 bits are added two at a time, in 32-bit lanes of 32 longs; no array is longer than these hold.
    """
    lanes = f"transform(sequence(0, 31), j -> aggregate({source}, 0L, (a, x) -> a + (shiftrightunsigned(x, j) & 4294967297L)))"
    count = "(shiftrightunsigned(lanes[CAST(b % 32 AS INT)], CAST(32 * (b DIV 32) AS INT)) & 4294967295L)"
    df = df.withColumn("lanes", F.expr(lanes))
    return df.withColumn(name, F.expr(f"aggregate(sequence(0, 63), 0L, (a, b) -> a | CASE WHEN 2 * {count} > size({source}) THEN shiftleft(1L, b) ELSE 0L END)")).drop("lanes")


def blocks(column: str) -> Column:
    """Number and bits of each of the RADIUS + 1 blocks of a fingerprint."""
    edges = [BITS * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    return F.array(
        *[F.struct(F.lit(k).alias("block"), F.expr(f"shiftrightunsigned({column}, {a}) & {(1 << (b - a)) - 1}L").alias("value")) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    )


def counted(df: DataFrame, source: str, name: str) -> DataFrame:
    """Adds an array's elements told apart by how often they came before, so that sets of them count."""
    df = df.withColumn("in_order", F.sort_array(source))
    return df.withColumn(name, F.expr("transform(in_order, (x, i) -> xxhash64(x, i - array_position(in_order, x)))")).drop("in_order")


def spots_of(lined: DataFrame, percent: int) -> DataFrame:
    """Starts of the windows to compare, per document and item length: those between neighbouring
    alignments, of which enough shingles are shared with items.

    A window of W shingles and an item of N reach ``percent`` with percent * (W + N) / (100 + percent) shared
    ones or more (``needed``). A window between alignments a and b holds at most 2N - (b - a) shingles from both,
    so for b - a > 2N - needed either one of them serves as well or none reaches it.
    Both arrays stay within the length of the document and the item.
    """
    spots = lined.groupBy("doc_id", "text_hash", "doc_words", "item_words").agg(F.sort_array(F.collect_set(F.col("doc_at") - F.col("item_at"))).alias("lines"), F.sort_array(F.collect_set("doc_at")).alias("held"))
    size = f"(item_words - {SHINGLE - 1})"
    spots = spots.withColumn("length", F.least("item_words", "doc_words")).withColumn("n", F.expr(f"length - {SHINGLE - 1}"))
    spots = spots.withColumn("needed", F.expr(f"CAST(({percent} * (n + {size}) + {99 + percent}) DIV {100 + percent} AS INT)"))
    gaps = f"flatten(transform(lines, (a, i) -> CASE WHEN i + 1 < size(lines) AND lines[i + 1] - a <= 2 * {size} - needed THEN sequence(a, lines[i + 1] - 1) ELSE array(a) END))"
    inside = "greatest(0, least(a, doc_words - length))"
    spots = spots.withColumn("starts", F.expr(f"array_distinct(transform({gaps}, a -> {inside}))")).withColumn("aligned", F.expr(f"array_distinct(transform(lines, a -> {inside}))"))
    # starts s with held[i + needed - 1] < s + n and s <= held[i] for some i, each once
    low = "greatest(held[i + needed - 1] - n + 1, CASE WHEN i > 0 THEN held[i - 1] + 1 ELSE 0 END)"
    enough = f"flatten(transform(held, (p, i) -> CASE WHEN i + needed <= size(held) AND {low} <= p THEN sequence({low}, p) ELSE CAST(array() AS array<int>) END))"
    spots = spots.withColumn("starts", F.array_intersect("starts", F.expr(enough))).where("size(starts) > 0")
    # the lined-up ones first among equals
    spots = spots.withColumn("aligned", F.array_intersect("starts", "aligned"))
    return spots.select("doc_id", "text_hash", F.expr("struct(item_words, length, aligned, array_except(starts, aligned) AS others)").alias("spot"))


def told_apart(starts: str) -> str:
    """Ascending starts without those whose window has the shingles of one up to PERIOD places before it, in any order.

    From a start to one p places on, a window loses its first p shingles and takes in p new ones. Words that repeat in a short
    cycle give windows of very few kinds, of which the first ones stay.
    """
    before = f"(CASE WHEN k < p AND get(of, i - k - 1) = x - p THEN sort_array(slice(shingles, x - p + 1, p)) = sort_array(slice(shingles, x - p + 1 + s.length - {SHINGLE - 1}, p)) ELSE false END)"
    known = f"exists(sequence(1, {PERIOD}), p -> exists(sequence(0, {PERIOD - 1}), k -> {before}))"
    return f"aggregate(array({starts}), CAST(array() AS array<int>), (a, of) -> filter(of, (x, i) -> NOT {known}))"


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """One row for each document and item found in it, with its best window: doc_id, text_hash, item_id,
    start (in words), n_words, shared, total, similarity."""
    ship(docs.sparkSession)
    items = benchmark.select("item_id", words(F.lower("text")).alias("w")).where(f"size(w) >= {SHINGLE}")
    items = items.select("item_id", F.size("w").alias("item_words"), shingles().alias("item_shingles"))
    items = stage(counted(simhash(items.distinct(), "item_shingles", "item_print"), "item_shingles", "item_counted"), "items")
    postings = items.select("item_id", "item_words", F.posexplode("item_shingles").alias("item_at", "shingle"))
    places = postings.select("shingle", "item_words", "item_at").distinct()

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.lower("text")).alias("w"))
    texts = rows.withColumn("shingles", shingles())
    # the outer form, since the plain one filters empty arrays first and works them out once more for that
    at = texts.select("doc_id", "text_hash", F.size("w").alias("doc_words"), F.posexplode_outer("shingles").alias("doc_at", "shingle"))
    known = postings.select("shingle").distinct()
    bound = items.agg(F.coalesce(F.sum(F.size("item_shingles")), F.lit(0))).first()[0] <= BROADCAST
    hits = at.join(F.broadcast(known) if bound else known, "shingle", "left_semi")
    # hits are few against all shingles; lining up takes them to every place of the items
    lined = hits.join(places, "shingle")
    spots = spots_of(lined, percent).groupBy("doc_id", "text_hash").agg(F.collect_list("spot").alias("spots"))
    spots = stage(spots, "spots")

    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    held = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    held = held.alias("d").join(spots.alias("s"), same).select("d.doc_id", "d.text_hash", words(F.lower("d.text")).alias("w"), "s.spots")
    held = held.withColumn("shingles", shingles())
    each = ", ".join(f"transform({told_apart(f's.{name}')}, x -> struct(s.item_words AS item_words, x AS start, {flag} AS aligned, s.length AS length))" for name, flag in (("aligned", "true"), ("others", "false")))
    # starts first, the shingles of one window at a time after that
    windows = held.select("doc_id", "text_hash", "shingles", F.explode(F.expr(f"flatten(transform(spots, s -> concat({each})))")).alias("x"))
    windows = windows.select("doc_id", "text_hash", "x.*", F.expr(f"slice(shingles, x.start + 1, x.length - {SHINGLE - 1})").alias("window_shingles"))
    # written down, lest each of the blocks works the fingerprint out anew
    windows = stage(counted(simhash(windows, "window_shingles", "print"), "window_shingles", "counted"), "windows")

    blocked = windows.select("*", F.explode(blocks("print")).alias("b")).select("*", "b.*").drop("b")
    item_blocks = items.select("*", F.explode(blocks("item_print")).alias("b")).select("*", "b.*").drop("b")
    near = blocked.join(item_blocks, ["item_words", "block", "value"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    # of the blocks in which a pair agrees only the first one counts
    edges = [BITS * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    earlier = " OR ".join(f"(block > {k} AND (shiftrightunsigned(print ^ item_print, {a}) & {(1 << (b - a)) - 1}L) = 0)" for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)))
    pairs = near.where(F.expr(f"NOT ({earlier})"))
    shared = F.size(F.array_intersect("counted", "item_counted"))
    pairs = pairs.withColumn("shared", shared).withColumn("total", F.size("window_shingles") + F.size("item_shingles") - F.col("shared"))
    found = pairs.where(F.col("shared") * 100 >= F.col("total") * percent).withColumn("similarity", F.col("shared") / F.col("total"))
    best = F.max_by(F.struct("start", F.col("length").alias("n_words"), "shared", "total", "similarity"), F.struct("similarity", "aligned", -F.col("start")))
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best")).select("doc_id", "text_hash", "item_id", "best.*")
