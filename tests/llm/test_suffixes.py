import numpy as np
import pytest
from cases import corpus, frame
from test_substrings import brute, words

from tidemark.llm import spans, suffixes


def covered(rows):
    return {(d, i) for d, start, n in rows for i in range(start, start + n)}


@pytest.mark.parametrize("size,head,parts,hot", [(50, 8, 1, 200), (50, 8, 4, 1), (12, 4, 3, 1), (12, 4, 2, 200), (5, 1, 3, 200), (6, 6, 2, 200)])
def test_equals_brute_force(spark, monkeypatch, size, head, parts, hot):
    monkeypatch.setattr(suffixes, "LEAST_HOT", hot)
    rows = [r for r in corpus(size) if r[0] != 1003]
    got = suffixes.passages(frame(spark, rows).repartition(parts), size, head).collect()
    first = {}
    for d, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            if d is not None:
                first.setdefault(tuple(w[k : k + size]), []).append(d)
    want, texts = set(), {r[0]: words(r[1]) for r in rows}
    for d, w in texts.items():
        for k in range(len(w) - size + 1):
            if d is not None and min(first[tuple(w[k : k + size])]) < d:
                want |= {(d, i) for i in range(k, k + size)}
    assert want and covered((r.doc_id, r.start, r.n_words) for r in got) == want
    assert len(covered((r.doc_id, r.start, r.n_words) for r in got)) == sum(r.n_words for r in got)  # whole passages
    for r in got:
        passage = texts[r.doc_id][r.start : r.start + r.n_words]
        assert r.earlier_doc_id < r.doc_id and r.n_words >= size
        assert any(r.earlier_doc_id in first.get(tuple(passage[k : k + size]), ()) for k in range(len(passage) - size + 1))


def test_without_and_cut_agree(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars").schema).repartition(3)
    found = suffixes.earlier_passages(df, 13, 4)
    left = spans.without(df, found).collect()
    key = lambda x: (x[0] is None, *map(str, x))
    assert sorted(((r.doc_id, " ".join(words(r.text))) for r in left), key=key) == sorted(((d, t) for d, _, _, t in brute(rows, 13)), key=key)
    before = {(r[0], r[1]) for r in rows}
    for r in left:
        assert (r.doc_id, r.text) in before or r.n_chars == len(r.text)
        assert r.text is None or chr(0xFFFD) not in r.text


def test_short_and_empty(spark):
    assert suffixes.passages(frame(spark, [])).count() == 0
    assert suffixes.passages(frame(spark, [(1, "a b", None, None, None), (2, "a b", None, None, None)])).count() == 0


@pytest.mark.parametrize("at_a_time", [1, 5, 4096])
def test_sorted_suffixes_equal_brute_force(monkeypatch, at_a_time):
    """Passages of six words over three different words, around heads of two: many neighbours differ in a single place."""
    monkeypatch.setattr(suffixes, "SORTED", at_a_time)
    r, size, head = np.random.default_rng(3), 6, 2
    before, n = r.integers(0, size - head + 1, 400), np.ones(400, np.int64)
    n = r.integers(1, np.minimum(before, 3) + 2)  # passages of a suffix all hold its head
    around = n + size - 1
    words = r.integers(1, 4, int(around.sum())).astype(np.uint64)
    first = np.cumsum(around) - around
    heads = np.array([int(words[f + b]) * 8 + int(words[f + b + 1]) for f, b in zip(first, before, strict=True)], np.uint64)
    ids = r.integers(0, 90, 400)
    late, least = suffixes._sorted(heads, before, n, words, ids, size, head)
    held = [(b - j, tuple(words[f + j : f + j + size]), i) for f, b, k, i in zip(first, before, n, ids, strict=True) for j in range(k)]
    low = {}
    for k, passage, i in held:
        low[k, passage] = min(i, low.get((k, passage), i))
    assert least.tolist() == [low[k, passage] for k, passage, _ in held]
    assert late.tolist() == [i > low[k, passage] for k, passage, i in held] and late.any() and not late.all()


def test_no_suffixes():
    none = np.empty(0, np.int64)
    late, least = suffixes._sorted(none.view(np.uint64), none, none, none.view(np.uint64), none, 50, 8)
    assert not len(late) and not len(least)
