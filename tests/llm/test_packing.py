import random

import numpy as np
import public_tokenizers
from cases import corpus, frame
from tokenizers import Tokenizer

from tidemark.llm import packing, tokenfiles

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_steps_equal_best_fit_decreasing():
    for seed in range(150):
        r = random.Random(seed)
        cap = r.choice([5, 20, 100])
        counts = {r.randint(1, cap): r.randint(1, 30) for _ in range(r.randint(1, 20))}
        plan, n = packing.best_fit(counts, cap)
        gaps = []
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                ok = [b for b in range(len(gaps)) if gaps[b] >= length]
                if ok:
                    gaps[min(ok, key=gaps.__getitem__)] -= length
                else:
                    gaps.append(cap - length)
        assert n == len(gaps)
        place, seen = {}, {length: [0] * c for length, c in counts.items()}
        for length, low, high, each, sequence, at in plan:
            for k in range(low, high):
                seen[length][k] += 1
                place.setdefault(sequence + (k - low) // each, []).append((at + (k - low) % each * length, length))
        assert all(x == 1 for v in seen.values() for x in v)
        for parts in place.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= cap


def test_pieces_and_sequences(spark):
    rows = corpus(4) + [(1000, "", None, None, None)] * 3
    whole = Tokenizer.from_file(PATH)
    for capacity in (64, 2048):
        got = packing.pack(frame(spark, rows).repartition(3), PATH, 0, capacity, keep_ids=True).collect()
        texts = sorted((str(d), whole.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, *_ in rows)
        want = sorted((d, k // capacity, k, x[k : k + capacity]) for d, x in texts for k in range(0, len(x), capacity))
        assert sorted((str(r.doc_id), r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
        assert all(r.length == len(r.ids) // 4 for r in got)
        fill = {}
        for r in got:
            fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in fill.values():
            assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
            assert sum(n for _, n in parts) <= capacity
        counts = {}
        for r in got:
            counts[r.length] = counts.get(r.length, 0) + 1
        assert len(fill) == packing.best_fit(counts, capacity)[1]
    assert packing.pack(frame(spark, []), PATH, 0).count() == 0


def test_bits_round_trip():
    r = np.random.default_rng(0)
    for width in (1, 3, 7, 8, 13, 16, 17, 24, 31, 32):
        ids = r.integers(0, 1 << width, 1001).astype(np.uint32)
        raw = tokenfiles.pack_bits(ids, width)
        assert len(raw) == -(-1001 * width // 8)
        assert (tokenfiles.unpack_bits(raw, width, 0, 1001) == ids).all()
        for at, n in ((0, 0), (5, 1), (13, 700), (1000, 1)):
            assert (tokenfiles.unpack_bits(raw, width, at, n) == ids[at : at + n]).all()
    assert [tokenfiles.width_of(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_IDS", 500)
    rows = corpus(6)
    whole = Tokenizer.from_file(PATH)
    path = str(tmp_path / "files")
    tokenfiles.write_token_files(frame(spark, rows).repartition(4), path, PATH, 49408, 2, shards=3)
    got = sorted((tuple(r) for r in tokenfiles.read_digest(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    ids = {}
    for d, t, *_ in rows:
        x = whole.encode(t or "", add_special_tokens=False).ids + [2]
        ids.setdefault(d, []).append((len(x), tokenfiles.crc(np.array(x)), x))
    at, everything = 0, []
    for d, start, n, crc in got:
        assert start == at
        k = next(i for i, x in enumerate(ids[d]) if x[:2] == (n, crc))
        everything += ids[d].pop(k)[2]
        at += n
    for start, n in ((0, 10), (490, 40), (at - 5, 5), (1234, 3000), (at, 5)):
        assert tokenfiles.read_ids(spark, path, start, n).tolist() == everything[start : start + n]
    path = str(tmp_path / "none")
    tokenfiles.write_token_files(frame(spark, []), path, PATH, 49408, 2)
    assert tokenfiles.read_digest(spark, path).count() == 0 and len(tokenfiles.read_ids(spark, path, 0, 5)) == 0
