import hashlib
import random
import re
import time

import numpy as np
import pytest
from cases import SCHEMA, corpus, frame

from tidemark.llm.personal import KINDS, candidates, digest, luhn, redacted, reliabilities, spans, unpacked

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [(kind, *m.span()) for kind, pattern in PATTERNS.items() for m in re.finditer(pattern, text or "") if passes(kind, m.group())]


def check(rows, docs):
    by_row = sorted((d, *[sum(k == kind for k, *_ in base(t)) for kind in KINDS], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base(t)).encode()).hexdigest()) for d, t in docs if d is not None)
    got = sorted((r["doc_id"], *[r[f"n_{k}"] for k in KINDS], r["base_sha256"]) for r in rows if r["doc_id"] is not None)
    assert got == by_row and len(rows) == len(docs)
    texts = {}
    for d, t in docs:
        texts.setdefault(d, []).append(t)
    for r in rows:
        listed = [x for x in r["spans"].split(",") if x]
        order = [(KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in listed)]
        assert order == sorted(order) and len(listed) == sum(r[f"n_{k}"] for k in KINDS) + r["n_added"]
        if len(texts[r["doc_id"]]) == 1:
            assert {f"{k}:{a}:{b}" for k, a, b in base(texts[r["doc_id"]][0])} <= set(listed)


def noisy(seed, n=400):
    r = random.Random(seed)
    pieces = ["a@b.c", "x@y", "@", ".", "-", "+", "1.2.3.4", "256.1.1.1", "01.002.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005", "+1 (377) 555-0271", "+", "7", "12", "(", ")", " ", "é", "🙂", "\n", "foo", "me%+x@mail.example.com.", "..", "--", "::", "call", "555-123-4567"]
    return [(i, "".join(r.choices(pieces, k=r.randint(0, 25)))) for i in range(n)]


def test_base_spans_equal_the_expressions(spark):
    docs = noisy(1)
    rows, _ = spans(frame(spark, [(d, t, None, None, None) for d, t in docs]), "doc_id")
    check(digest(rows).collect(), docs)


def test_odd_rows(spark):
    docs = [(d, t) for d, t, *_ in corpus(n=40)]
    rows, _ = spans(frame(spark, [(d, t, None, None, None) for d, t in docs]), "doc_id")
    check(digest(rows).collect(), docs)
    assert spans(spark.createDataFrame([], SCHEMA), "doc_id")[0].collect() == []


def test_real_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, _ = spans(docs, "doc_id")
    check(digest(rows).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("text", ["1" * 400_000, "a" * 400_000, "1.2." * 100_000, "+1" * 200_000, "a@" * 200_000, "a." * 200_000 + "@", "1 " * 200_000, " at " * 100_000, "f:" * 200_000, "@b." * 100_000, "+1 " + "(" * 400_000])
def test_long_texts_take_linear_time(text):
    begin = time.perf_counter()
    candidates(text)
    assert time.perf_counter() - begin < 10


def planted(seed, n):
    """Texts with base spans, further true ones that context gives away, and look-alikes; with the true further ones."""
    r = random.Random(seed)
    digit = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card(k, ok, first="37"):
        while True:
            x = first + digit(k - len(first))
            if luhn(x) == ok and len(set(x)) > 4:
                return x

    docs, more = [], []
    for i in range(n):
        kind = r.choice(["phone", "amex", "spoken", "order", "version", "card", "email", "call", "serial", "host"])
        area = r.choice("23456789") + digit(2)
        body, true = {
            "phone": (f"call +1 ({area}) {digit(3)}-{digit(4)}", False),
            "card": (f"card {card(16, True, '4')}", False),
            "email": (f"mail {'ab'}{digit(2)}@mail.example.com", False),
            "amex": (f"card {card(15, True)}", True),
            "call": (f"call {area}-{digit(3)}-{digit(4)}", True),
            "spoken": (f"email joe{digit(2)} (at) mail (dot) example.com", True),
            "order": (f"order {card(15, False, '99')}", False),
            "version": (f"version {r.randint(256, 999)}.{digit(1)}.{digit(2)}.{digit(1)}", False),
            "serial": (f"serial x{digit(3)}-{digit(3)}-{digit(4)}z", False),
            "host": (f"build root@node{digit(1)}_", False),
        }[kind]
        docs.append((i, f"the quick fox {body} and more words"))
        more.append((kind, true, body.split(" ", 1)[1]))
    return docs, more


def test_added_spans_on_texts_not_learned_from(spark):
    from tidemark.llm import personal

    docs, _ = planted(1, 600)
    _, model = spans(frame(spark, [(d, t, None, None, None) for d, t in docs]), "doc_id")
    assert set(model.reliable) >= {0, 2, 3}
    held, more = planted(2, 400)
    hits = {}
    for (_, text), (kind, true, body) in zip(held, more, strict=True):
        row = [{"kind": c.kind, "start": c.start, "end": c.end, "base": c.base, "flags": personal.flags(c, text, personal.votes(c, text))} for c in candidates(text)]
        added = [c for c in personal._chosen(row, model) if not c["base"]]
        hits.setdefault((kind, true), []).append(bool(added))
        assert not added or added[0]["end"] - added[0]["start"] <= len(body)
    for (kind, true), got in hits.items():
        assert np.mean(got) >= 0.95 if true else np.mean(got) <= 0.05, (kind, true, np.mean(got))


def test_expectation_maximisation_finds_the_labelers_reliabilities():
    r = np.random.default_rng(5)
    says = np.array([[[0.8, 0.15, 0.05], [0.6, 0.3, 0.1], [0.1, 0.85, 0.05], [0.3, 0.4, 0.3], [0.5, 0.2, 0.3], [0.7, 0.1, 0.2]], [[0.05, 0.05, 0.9], [0.1, 0.3, 0.6], [0.02, 0.58, 0.4], [0.3, 0.4, 0.3], [0.2, 0.2, 0.6], [0.1, 0.1, 0.8]]])
    truth = r.random(40_000) < 0.3
    drawn = r.random((40_000, 6, 1)) > np.cumsum(says, 2)[truth.astype(int)]
    patterns = (drawn.sum(2) * 3 ** np.arange(6)).sum(1)
    found, n = np.unique(patterns, return_counts=True)
    model = reliabilities(unpacked(found), n.astype(float))
    assert abs(model.share - 0.3) < 0.03 and np.abs(model.says - says).max() < 0.05
    p = model.chance(unpacked(patterns))
    assert ((p > 0.5) == truth).mean() > 0.95


def test_redaction(spark):
    docs = frame(spark, [(1, "write a@b.co or +1 (377) 555-0271!", None, None, None), (2, None, None, None, None), (3, "none", None, None, None)])
    assert dict(map(tuple, redacted(docs).collect())) == {1: "write <email> or <phone>!", 2: None, 3: "none"}
