import public_tokenizers
import pytest
from cases import corpus, frame
from test_decontam import brute as leaks
from test_neardups import brute as near
from test_substrings import words
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import tokens

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """A folder with the tables the stages read."""
    path = str(tmp_path_factory.mktemp("sf"))
    rows = [r for r in corpus(11, 150) if r[0] != 1003]
    items = [(k, " ".join(f"item{k}x{j}" for j in range(20 + 9 * k))) for k in range(4)]
    rows += [(6000 + k, f"{rows[k][1] or ''}\n{items[k % 4][1]}", None, "s", 7) for k in range(9)]
    labels = []
    for k in range(400):
        toxic = k % 4 == 0
        rows.append((7000 + k, " ".join(f"t{(k * 13 + j * (k + 3)) % 601}" for j in range(40)) + (" zorkish vexmonger zorkle" if toxic else ""), "en", "t", 1))
        labels.append((7000 + k, 1, int(toxic)))
    df = frame(spark, rows)
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


def test_stages_against_brute_force(spark, inputs):
    docs = spark.read.parquet(f"{inputs}/documents.parquet")
    columns = docs.columns
    step = dict(corpus_pipeline.STAGES)
    before = rows_of(docs)

    def run(name):
        nonlocal docs
        docs = corpus_pipeline.stage(step[name](spark, docs, inputs), name)
        assert docs.columns == columns
        return rows_of(docs)

    after = run("toxicity")
    assert after == [r for r in before if "zorkish" not in (r[1] or "")]
    before = after

    gone = {d for d, _, _, kept in near(before) if not kept}
    after = run("near_duplicates")
    assert gone and after == [r for r in before if r[0] not in gone]
    before = after

    first = {}
    for d, t, *_ in before:
        w = words(t)
        for k in range(len(w) - 49):
            if d is not None:
                key = tuple(w[k : k + 50])
                first[key] = min(first.get(key, d), d)
    want = []
    for d, t, lang, source, n in before:
        w = words(t)
        lost = {k + j for k in range(len(w) - 49) if d is not None and first[tuple(w[k : k + 50])] < d for j in range(50)}
        want.append((d, [x for i, x in enumerate(w) if i not in lost], lang, source, bool(lost)))
    after = run("repeated_passages")
    assert any(x[4] for x in want)
    assert sorted(((d, words(t), lang, source) for d, t, lang, source, _ in after), key=str) == sorted((x[:4] for x in want), key=str)
    whole = {x[0] for x in want if not x[4]}
    assert [r for r in after if r[0] in whole] == [r for r in before if r[0] in whole]
    assert all(r[4] == len(r[1]) for r in after if r[0] not in whole)
    before = after

    items = [tuple(r) for r in spark.read.parquet(f"{inputs}/benchmark.parquet").collect()]
    found = {d for d, *_ in leaks(before, items)}
    after = run("decontamination")
    assert found and after == [r for r in before if r[0] not in found]

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = step["best_fit_packing"](spark, docs, inputs).collect()
    ids = sorted((r[0] if r[0] is not None else -1, whole.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in after)
    want = sorted((d, k // 2048, k, min(2048, len(x) - k), tokens.crc(__import__("numpy").array(x[k : k + 2048]))) for d, x in ids for k in range(0, len(x), 2048))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == want
    fill = {}
    for r in pieces:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in pieces)
    assert len(fill) <= -(-total // 2048) * 1.1 + 1


def test_run_equals_its_stages(spark, inputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "best_fit_packing"]
    got = corpus_pipeline.run(spark, inputs)
    assert got.count() > 100 and got.where("offset + length > 2048").count() == 0
