import itertools
import random

import numpy as np
from cases import frame

from tidemark.llm import toxicity


def maximal(scores):
    """All maximal segments by their definition: positive, cannot be raised by growing or shrinking."""
    out = []

    def split(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-9 and (best is None or total > best[2] + 1e-9 or (abs(total - best[2]) <= 1e-9 and j - i < best[1] - best[0])):
                    best = (i, j, total)
        if best:
            split(a, best[0])
            out.append(best)
            split(best[1] + 1, b)

    split(0, len(scores))
    return out


def test_segments_equal_their_definition():
    for seed in range(200):
        r = random.Random(seed)
        n = r.randint(1, 30)
        place = np.array(sorted(r.sample(range(n), r.randint(1, n))))
        score = np.array([r.choice([0.7, 1.3, 2.1, 3.7]) for _ in place])
        scores = [-0.45] * n
        for p, s in zip(place, score, strict=True):
            scores[p] = s
        got = toxicity.segments(place, score, 0.45)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in maximal(scores)], seed
        assert np.allclose([s for _, _, s in got], [s for _, _, s in maximal(scores)])


def corpus(n=1500):
    r = random.Random(1)
    words = ["".join(r.choice("abcde") for _ in range(r.randint(2, 6))) for _ in range(800)]
    docs, labels = [], []
    for d in range(n):
        text = [r.choice(words) for _ in range(r.randint(20, 200))]
        toxic = d % 6 == 0
        if toxic:
            for _ in range(r.randint(2, 5)):
                text.insert(r.randrange(len(text)), r.choice(["Zorkish!", "zorkle", "vexmonger,"]))
        docs.append((d, " ".join(text), None, None, None))
        labels.append((d, 1, int(toxic)))
    docs += [(9001, None, None, None, None), (9002, "", None, None, None), (None, "zorkle vexmonger", None, None, None), (9003, "zorkle " * 3000, None, None, None)]
    labels += [(9001, None, None), (None, 1, 1), (3, 1, 0), (3, 1, 0)]
    return docs, labels


SCHEMA = "doc_id long, quality int, toxic int"


def test_held_out_documents(spark):
    docs, labels = corpus()
    learn = [x for x in labels if x[0] is None or x[0] % 5]
    scored, model = toxicity.score(frame(spark, docs).repartition(3), spark.createDataFrame(learn, SCHEMA))
    by = {r.doc_id: r for r in scored.collect()}
    held = [d for d, *_ in docs if d is not None and d < 9000 and d % 5 == 0]
    right = [(by[d].score >= 0.5) == (d % 6 == 0) for d in held]
    assert np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in by.values())
    assert by[9001].score == by[9002].score < 0.1 and by[9001].n_words == 0
    assert by[9003].score > 0.9 and by[None].score > 0.5
    texts = dict((d, (t or "").lower()) for d, t, *_ in docs)
    for d in held:
        for p in by[d].passages:
            w = texts[d].replace("!", "").replace(",", "").split()[p.start : p.start + p.n_words]
            assert p.expected < toxicity.SIGNIFICANT and {w[0][:4], w[-1][:4]} <= {"zork", "vexm"} | {x[:4] for x in w if d % 6}


def test_law_does_not_depend_on_the_length_of_texts(spark):
    docs, labels = corpus()
    some = [(d, f"{t} zorkle" if d is not None and d < 9000 and d % 50 == 1 else t, *x) for d, t, *x in docs]
    laws = []
    for times in (1, 10):
        long = [(d, t and " ".join([t] * times), *x) for d, t, *x in some]
        laws.append(toxicity.learn_words(frame(spark, long), spark.createDataFrame(labels, SCHEMA)))
    assert np.array_equal(laws[0].words, laws[1].words) and np.allclose(laws[0].scores, laws[1].scores)
    assert abs(laws[0].decay / laws[1].decay - 1) < 0.1, laws


def test_lists_every_token_that_passes(spark):
    r = random.Random(3)
    words = ["".join(c) for c in r.sample(list(itertools.product("abcdefghijklmnopqrst", repeat=4)), 21_000)]
    docs = [(d, " ".join(words) if d % 2 else "plain text " * 20, None, None, None) for d in range(60)]
    model = toxicity.learn_words(frame(spark, docs), spark.createDataFrame([(d, 1, d % 2) for d in range(60)], SCHEMA))
    assert len(model.words) == len(words)


def test_nothing_to_learn(spark):
    docs, labels = corpus(30)
    for some in ([], [x for x in labels if x[2] == 0]):
        scored, _ = toxicity.score(frame(spark, docs), spark.createDataFrame(some, SCHEMA))
        assert scored.count() == len(docs) and scored.where("score <> 0 OR score IS NULL").count() == 0
    scored, _ = toxicity.score(frame(spark, []), spark.createDataFrame(labels, SCHEMA))
    assert scored.count() == 0


def test_query(spark):
    from tidemark.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op10_segment_toxicity"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.93 * len(got)
