import random
import re
from collections import Counter, defaultdict

import pytest
from cases import SCHEMA, corpus, frame
from pyspark.sql import functions as F

from tidemark.llm.collocations import collocations


def brute(rows, top=2000, least=10):
    """The definition, phrase by phrase."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = defaultdict(int)
        for p, a in candidates.items():
            if len(p) == 3:
                for short in (p[:2], p[1:]):
                    covered[short] = max(covered[short], a)
        kept = []
        for p, a in candidates.items():
            if len(p) == 2 and p in covered and 100 * covered[p] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def zipf(seed, n=150, langs=("en", "de", None)):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Ünder", "THE", "naïve"]
    weights = [1 / (k + 1) for k in range(len(words))]
    phrases = [" ".join(r.choices(words, k=r.choice([2, 3, 3]))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 60)):
            parts += [r.choice(phrases)] if r.random() < 0.25 else r.choices(words, weights)
            parts += [r.choice([" ", " ", " ", "\t", "  ", ". ", ", ", "\n", "!? "])]
        rows.append((i, "".join(parts), r.choice(langs), None, None))
    return rows


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("top,least,first", [(2000, 10, 2), (7, 3, 1), (30, 2, 1)])
def test_equals_the_definition(spark, top, least, first):
    rows = zipf(top)
    got = found(collocations(frame(spark, rows), top, least, first))
    assert got and got == brute(rows, top, least)


def test_several_rounds_settle_what_a_first_level_leaves_open(spark):
    # most pairs by score are parts of longer phrases, so that the first level yields too few survivors
    r = random.Random(3)
    names = [(f"a{k}", f"b{k}", f"c{k}") for k in range(40)]
    rows = [(i, ". ".join([" ".join(x) for x in r.sample(names, 20)] + [" ".join(r.choices(["x", "y", "z", "u", "v"], k=12))]), "en", None, None) for i in range(60)]
    expected = brute(rows, 60, 5)
    assert found(collocations(frame(spark, rows), 60, 5, 1)) == expected
    assert any(score < 1_000_000 for *_, score in expected)


def test_shared_bits_change_nothing(spark):
    rows = zipf(5)
    assert found(collocations(frame(spark, rows), 50, 2, 1, bits=8)) == brute(rows, 50, 2)


def test_odd_rows(spark):
    rows = corpus() + [(9001, "x y " * 30_000, "en", None, None), (9002, "q" * 200_000, None, None, None)]
    assert found(collocations(frame(spark, rows), 300, 3)) == brute(rows, 300, 3)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(collocations(empty)) == []
    assert found(collocations(frame(spark, [(1, None, "en", None, None), (2, " .\t", None, None, None)]))) == []


def test_repeated_rows_count_twice(spark):
    rows = zipf(2, n=40)
    assert found(collocations(frame(spark, rows).unionAll(frame(spark, rows)), 20, 4)) == brute(rows + rows, 20, 4)


def test_real_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", F.lit(None), F.lit(None)).collect()]
    assert found(collocations(docs)) == brute(rows)
