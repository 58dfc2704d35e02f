import hashlib
import re

import pytest
from cases import corpus, frame

from tidemark.llm import substrings


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, size):
    first = {}
    for d, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            if d is not None:
                key = tuple(w[k : k + size])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t, *_ in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if d is not None and first[tuple(w[k : k + size])] < d:
                gone.update(range(k, k + size))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


key = lambda x: (x[0] is None, *map(str, x))


@pytest.mark.parametrize("size,gram,parts", [(13, 3, 1), (13, 3, 5), (5, 2, 3), (2, 1, 2)])
def test_equals_brute_force(spark, size, gram, parts):
    rows = corpus(size)
    got = substrings.dedup(frame(spark, rows).repartition(parts), size, gram).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, size), key=key)


@pytest.mark.parametrize("remembered", [0, 3, 1000])
def test_hot_minimisers(spark, monkeypatch, remembered):
    monkeypatch.setattr(substrings, "SAMPLED", 1)
    monkeypatch.setattr(substrings, "REMEMBERED", remembered)
    line = " ".join(f"line{k}" for k in range(16))
    rows = corpus(21) + [(8000 - k, f"a{k} b{k} c{k} {line} d{k} e{k} {'f' * (k % 4)} g{k}", None, None, None) for k in range(150)]
    docs = frame(spark, rows).repartition(3)
    assert len(substrings.hot_minimisers(docs, 13, 3, 32)) > 0
    got = substrings.dedup(docs, 13, 3).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 13), key=key)


def test_empty_table(spark):
    assert substrings.dedup(frame(spark, [])).count() == 0


def test_query(spark, sf_dir):
    from tidemark.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = {(d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, n, m, t in brute(rows, 13)}
    assert {tuple(r) for r in QUERIES["op7_super_kmer_dedup"](spark, sf_dir).collect()} == want
