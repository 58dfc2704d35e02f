import random
import re
import time
from collections import Counter

from cases import corpus, frame

from tidemark.llm import decontam


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def shingles(w):
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)]


def brute(rows, items):
    out = {}
    for d, t, *_ in rows:
        w = words(t)
        s = shingles(w)
        for item, text in items:
            v = words(text)
            want = Counter(shingles(v))
            for p, x in enumerate(s):
                for q, y in enumerate(shingles(v)):
                    if x == y:
                        n = min(len(v), len(w))
                        start = max(0, min(p - q, len(w) - n))
                        have = Counter(shingles(w[start : start + n]))
                        shared, total = sum((have & want).values()), sum((have | want).values())
                        if 100 * shared >= 75 * total:
                            best = (shared / total, -start, n, shared, total)
                            out[d, hash(t), item] = max(out.get((d, hash(t), item), best), best)
    return sorted(((d, item, -start, n, shared, total) for (d, _, item), (_, start, n, shared, total) in out.items()), key=str)


def case(seed):
    r = random.Random(seed)
    rows = corpus(seed, 60)
    pick = ["".join(r.choice("uvwxyz") for _ in range(r.randint(2, 7))) for _ in range(300)]
    items = [(k, " ".join(r.choice(pick) for _ in range(r.choice([3, 5, 8, 20, 40, 60])))) for k in range(24)]
    items += [(50, items[4][1]), (51, None), (52, ""), (53, "again and again and again and again and again and again")]
    for k, (_, text) in enumerate(items):
        w = (text or "").split()
        for _ in range(r.randint(0, 2)):
            if w:
                i = r.randrange(len(w))
                w[i : i + 1] = r.choice([[], [w[i].upper()], ["edit"], [w[i], "more"]])
        rows.append((4000 + k, f"{rows[k][1] or ''} {' '.join(w)}\n{r.choice(['', 'after it some words'])}", None, None, None))
    rows.append((5000, " ".join(t or "" for _, t in items) * 2, None, None, None))
    rows.append((None, items[5][1], None, None, None))
    return rows, items


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows, items = case(seed)
        got = decontam.leaks(frame(spark, rows).repartition(3), spark.createDataFrame(items, "item_id long, text string"))
        got = sorted(((r.doc_id, r.item_id, r.start, r.n_words, r.shared, r.total) for r in got.collect()), key=str)
        assert got == brute(rows, items) and len(got) > 20


def all_windows(rows, items):
    """Best counts over the windows of every start, and the starts that have them."""
    out = {}
    for d, t, *_ in rows:
        w = words(t)
        for item, text in items:
            v = words(text)
            n = min(len(v), len(w))
            if n < 5:
                continue
            want, held = Counter(shingles(v)), shingles(w)
            for start in range(len(w) - n + 1):
                have = Counter(held[start : start + n - 4])
                shared, total = sum((have & want).values()), sum((have | want).values())
                if 100 * shared >= 75 * total:
                    out.setdefault((d, item), {}).setdefault((shared / total, shared, total), set()).add(start)
    return {k: (*max(v)[1:], v[max(v)]) for k, v in out.items()}


def test_finds_what_any_window_finds(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("klmnop") for _ in range(6))
    items, rows = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([48, 48, 40, 60, 25, 59, 36, 48])], []
    around = lambda w: " ".join([word() for _ in range(r.randint(0, 80))] + w + [word() for _ in range(r.randint(0, 80))])
    for k, text in items:
        w = text.split()
        half = len(w) // 2
        two = ["first", *w[1:half], "put", "in", *w[half:-1], "last"]
        rows += [(100 + k, around(two), None, None, None), (200 + k, around(w[half:] + w[:half]), None, None, None), (300 + k, " ".join(two), None, None, None)]
        for n in range(12):
            v = list(w)
            for _ in range(r.randint(1, 3)):
                i = r.randrange(len(v))
                v[i : i + r.randint(0, 2)] = [word() for _ in range(r.randint(0, 2))]
            rows.append((1000 + 100 * k + n, around(v), None, None, None))
    want = all_windows(rows, items)
    assert (100, 0) in want and (200, 0) in want
    got = {(x.doc_id, x.item_id): x for x in decontam.leaks(frame(spark, rows).repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == set(want)
    for k, x in got.items():
        shared, total, starts = want[k]
        assert (x.shared, x.total) == (shared, total) and x.start in starts, k


def test_shuffled_when_the_benchmark_is_large(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST", 0)
    rows, items = case(3)
    got = decontam.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.item_id, r.start, r.n_words, r.shared, r.total) for r in got), key=str) == brute(rows, items)


def test_empty_tables(spark):
    rows, items = case(4)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(frame(spark, rows), none).count() == 0
    assert decontam.leaks(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_simhash_blocks_find_all_within_the_radius(spark):
    r = random.Random(0)
    pairs = []
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randint(0, decontam.RADIUS)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long").select(decontam.blocks("a").alias("a"), decontam.blocks("b").alias("b"))
    assert df.where("size(array_intersect(a, b)) = 0").count() == 0


def test_simhash_is_the_majority(spark):
    r = random.Random(2)
    arrays = [[r.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 3, 36, 300)]
    got = decontam.simhash(spark.createDataFrame([(a,) for a in arrays], "h array<long>"), "h", "p").collect()
    for row in got:
        assert [(row.p >> b) & 1 for b in range(64)] == [int(2 * sum((x >> b) & 1 for x in row.h) > len(row.h)) for b in range(64)]


def test_no_python_on_the_way(spark, sf_dir):
    from tidemark.llm.queries import QUERIES

    for name in ("op4_simhash_decontamination", "op6_risk_controlled_quality"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_repetitive_and_long_texts_take_few_windows(spark):
    items = [(1, "ha " * 200), (2, "a b " * 60), (3, " ".join("xyz"[k % 3] for k in range(90))), (4, "once upon a time there was a very small item of words")]
    docs = [(1, "ha " * 20_000), (2, "b a " * 9_000 + "end"), (3, "x y z " * 3_000), (4, "ha " * 150), (5, "q " * 20_000 + items[3][1] + " q" * 2_000)]
    begin = time.perf_counter()
    rows = [(d, t, None, None, None) for d, t in docs]
    got = decontam.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert time.perf_counter() - begin < 60
    found = {(x.doc_id, x.item_id): (x.shared, x.total) for x in got}
    assert found.pop((4, 1), (146, 196)) == (146, 196)  # 150 equal words: just below the threshold
    assert found == {(1, 1): (196, 196), (2, 2): (116, 116), (3, 3): (86, 86), (5, 4): (8, 8)}


def test_low_variety_equals_all_windows(spark):
    r = random.Random(6)
    items = [(k, " ".join(r.choice("aaab") for _ in range(n))) for k, n in enumerate((12, 20, 30))] + [(9, "a b c d " * 6)]
    rows = [(k, " ".join(r.choice("aaab") for _ in range(r.randint(10, 60))), None, None, None) for k in range(40)]
    rows += [(50, "a b c d " * 20, None, None, None), (51, "b b b b a " * 12, None, None, None), (52, items[2][1] + " c " + items[2][1], None, None, None)]
    want = all_windows(rows, items)
    got = {(x.doc_id, x.item_id): x for x in decontam.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == set(want) and len(want) > 3
    for k, x in got.items():
        assert (x.shared, x.total) == want[k][:2] and x.start in want[k][2], k


def test_simhash_of_a_long_array(spark):
    h = spark.range(1).selectExpr("transform(sequence(1, 70000), i -> CASE WHEN i <= 36000 THEN -1L ELSE 5L END) AS h")
    assert decontam.simhash(h, "h", "p").first().p == -1
