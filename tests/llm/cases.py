"""Small documents for brute-force comparisons: copies, edits, shared passages, odd rows."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


def corpus(seed=7, n=120):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(400)] + ["the", "of", "and"] * 30
    text = lambda k: "".join(r.choice(words) + r.choice([" ", " ", "\n", "\t ", "  "]) for _ in range(k))
    shared = [text(k) for k in (13, 20, 55, 70, 90)]
    docs = []
    for i in range(n):
        kind = r.random()
        if kind < 0.25 and docs:
            base = r.choice(docs)[1] or ""
            parts = base.split()
            for _ in range(r.randint(0, max(1, len(parts) // 25))):
                if parts:
                    parts[r.randrange(len(parts))] = r.choice(words)
            t = " ".join(parts)
        elif kind < 0.6:
            t = text(r.randint(0, 120)) + r.choice(shared) + text(r.randint(0, 40)) + (r.choice(shared) if r.random() < 0.5 else "")
        elif kind < 0.7:
            t = (text(r.randint(1, 20)) + " ") * r.randint(2, 8)
        else:
            t = text(r.randint(0, 200))
        docs.append((i * 3 % (n + 7), t))
    docs += [(1000, ""), (1001, None), (None, shared[4]), (None, None), (1002, " \n\t "), (1003, text(3)), (1003, shared[3]), (1003, shared[3]), (1004, text(5000) + shared[2]), (1005, "The THE of"), (1005, "the the OF")]
    r.shuffle(docs)
    return [(d, t, r.choice(["en", "de", None]), None, None) for d, t in docs]


def frame(spark, rows):
    """With extra columns whose names operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("text_hash", "start", "n", "spans", "bucket", "kept", "n_words", "score", "words", "rank", "length", "task", "_doc", "_hash", "_start", "_n", "_cut", "_spans", "__doc"):
        df = df.withColumn(name, F.lit("x"))
    return df
