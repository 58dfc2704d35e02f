import re

import numpy as np
import pytest
from cases import corpus, frame

from tidemark.llm import neardups
from tidemark.llm.components import components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    top = {r[0]: r[0] for r in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and a[0] is not None and rows[j][0] is not None and 100 * both >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((find(a[0]), find(rows[j][0])))
                top[y] = x
    return sorted(
        [(r[0], len(s), (find(r[0]) if s else r[0]) if r[0] is not None else None, r[0] is None or r[0] == (find(r[0]) if s else r[0])) for r, s in zip(rows, sets, strict=True)],
        key=str,
    )


def result(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()], key=str)


@pytest.mark.parametrize("chunk", [2048, 8])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(neardups, "CHUNK", chunk)
    rows = corpus(3, 160)
    base = " ".join(f"w{k}" for k in range(90)).split()
    for k in range(40):  # near copies of one text, some of them too far from it
        t = list(base)
        for e in range(k // 4):
            t[(e * 37 + k * 11) % 90] = f"x{k}{e}"
        rows.append((5000 - k, " ".join(t), None, None, None))
    assert result(neardups.near_duplicates(frame(spark, rows).repartition(3))) == brute(rows)


def test_empty_table(spark):
    assert neardups.near_duplicates(frame(spark, [])).count() == 0


def test_registers_estimate_and_merge():
    r = np.random.default_rng(1)
    x = np.unique(r.integers(0, 2**63, 4000).astype(np.uint64))
    a, b = x[:3500], x[500:]
    both = neardups.registers(np.concatenate([a, b, x]), np.array([len(a), len(b), len(x)]))
    assert (np.maximum(both[0], both[1]) == both[2]).all()
    assert abs((both[0] == both[1]).mean() - 3000 / 4000) < 0.13
    n = np.array([3500.0])
    assert neardups.may_reach(both[:1], both[1:2], n, n).all()
    assert not neardups.may_reach(both[:1], neardups.registers(x[::-1][:700] + np.uint64(1), np.array([700])), n, np.array([3500.0])).any()


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 300), (7, 7), (None, 3), (300, 100)] + [(1000, k) for k in range(1001, 1100)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 200, 300), 100), **dict.fromkeys(range(1000, 1100), 1000)}


def test_query(spark, sf_dir):
    from tidemark.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op8_setsketch_near_dedup"](spark, sf_dir)) == brute(rows)
