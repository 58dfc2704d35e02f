import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from cases import corpus, frame
from tokenizers import Tokenizer

from tidemark.llm import tokenfiles
from tidemark.llm.tokens import Encoder, crc, with_end

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, "   \n\t ", "a", "Don't we'll I'VE 'tis x''s <|endoftext|> a<|startoftext|>b <b>", "a b c\u0085d", "ÀÉÎ×÷ÿß ẞ İstanbul ΣΑΣ ς",
    "é café cafés ́x", "123 4a5 a-b--c ###!! x\x00y \x1f", "日本語テキスト 中文 🙂🙂 ok", "\x1ca\x1db", "x" * 3000, "½ ²³ Ⅷ ٣٤", "﻿bom", "ÃÃ",
]


def test_ids_equal_those_of_whole_texts(sf_dir):
    texts = ODD + pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"]).column(0).to_pylist()
    whole = Tokenizer.from_file(PATH)
    encoder = Encoder(PATH)
    for part in (texts, ODD, [None, ""], []):
        ids, offsets = encoder.batch(pa.array(part, pa.string()))
        for k, text in enumerate(part):
            want = whole.encode(text or "", add_special_tokens=False).ids
            assert ids[offsets[k] : offsets[k + 1]].tolist() == want, repr(text)[:80]
        assert offsets[-1] == len(ids)


def test_end_ids_and_crc():
    ids, offsets = with_end(np.array([5, 6, 7], np.uint32), np.array([0, 2, 2, 3]), 2)
    assert ids.tolist() == [5, 6, 2, 2, 7, 2] and offsets.tolist() == [0, 3, 4, 6]
    assert crc(np.array([1], np.uint32)) == __import__("zlib").crc32(b"\x01\x00\x00\x00")


def test_lookups_read_the_blocks_they_need(spark, tmp_path):
    path = str(tmp_path / "tokens")
    tokenfiles.write_token_files(frame(spark, corpus(5)), path, PATH, 49408, 2, shards=4)
    rows = spark.read.parquet(path).orderBy("shard", "first").collect()
    starts = tokenfiles.shard_starts(spark, path)
    at = [(starts[r.shard] + r.first, r.n_ids) for r in rows]
    total = sum(n for _, n in at)
    assert len(starts) > 2
    for start, count in [(0, 1), (at[1][0], 5), (at[1][0] - 1, 2), (at[2][0] - 3, at[2][1] + 9), (0, total), (total - 1, 4)]:
        found = tokenfiles.blocks_at(spark, path, start, count)
        want = [a for a, n in at if a < start + count and a + n > start]
        assert sorted(r["at"] for r in found.select("at").collect()) == want
        assert len(tokenfiles.read_ids(spark, path, start, count)) == min(count, total - start)
    for start, count in [(total, 4), (5, 0)]:
        assert len(tokenfiles.read_ids(spark, path, start, count)) == 0
    plan = tokenfiles.blocks_at(spark, path, at[1][0] + 1, 3)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(shard," in pushed and "GreaterThanOrEqual(first," in pushed and "LessThan(first," in pushed
