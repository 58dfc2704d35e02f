import numpy as np
from cases import frame

from tidemark.llm import langid


def test_gradient_by_differences():
    r = np.random.default_rng(0)
    net = langid.Network(["a", "b", "c"])
    for name in ("embedding", "bias", "dense", "offset"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters = [f.astype(np.float64) for f in net.filters]
    windows, target = r.integers(0, 256, (4, langid.LENGTH)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        return -np.log(direct(net, windows)[np.arange(4), target]).mean()

    for x, g in zip(net.weights(), net.gradient(windows, target), strict=True):
        for _ in range(12):
            at = tuple(r.integers(0, s) for s in x.shape) if x is not net.embedding else (windows[0, r.integers(0, langid.LENGTH)], r.integers(0, langid.EMBEDDING))
            old, step = x[at], 1e-6
            x[at] = old + step
            up = loss()
            x[at] = old - step
            down = loss()
            x[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 1e-4


def direct(net, windows):
    """The network as it is defined, place by place."""
    embedded = net.embedding[windows]
    pooled = []
    for w, f in zip(langid.WIDTHS, net.filters, strict=True):
        places = [embedded[:, k : k + w].reshape(len(windows), -1) @ f for k in range(langid.LENGTH - w + 1)]
        pooled.append(np.max(places, axis=0))
    return langid.softmax(np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0) @ net.dense + net.offset)


def test_tables_give_the_network():
    r = np.random.default_rng(1)
    net = langid.Network(["a", "b"])
    windows = r.integers(0, 256, (70, langid.LENGTH)).astype(np.uint8)
    assert np.allclose(net.apply(windows, net.tables()), direct(net, windows), atol=1e-4)


def test_windows_cover_texts():
    texts = [b"", b"a" * 5, b"b" * langid.LENGTH, b"c" * (langid.LENGTH + 1), b"d" * 1000]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    windows, text, held = langid.cut(data, offsets)
    for k, t in enumerate(texts):
        assert b"".join(w[:n].tobytes() for w, n in zip(windows[text == k], held[text == k], strict=True)) == t


def test_odd_rows(spark):
    rows = [(k, "der die das und nicht ein Haus " * 9 if k % 2 else "the and of with from that house " * 9, "de" if k % 2 else "en", None, None) for k in range(60)]
    odd = [(100, None, "en", None, None), (101, "", "de", None, None), (102, " 12 !? 3", "en", None, None), (None, "der die das und nicht", "de", None, None), (103, "the and of", None, None, None), (103, "the and of", None, None, None), (104, "DER DIE DAS UND NICHT " * 400, None, None, None)]
    docs = frame(spark, rows + odd).repartition(2)
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, langid.learn(docs)).collect()]
    by = {d: (p, s) for d, p, s in got}
    assert len(got) == len(rows) + len(odd) and all(0 <= s <= 1 for _, _, s in got)
    assert by[100] == by[101] == by[102] == ("und", 0.0) and by[None][0] == by[104][0] == "de" and by[103][0] == "en"
    assert all(by[d][0] == lang for d, _, lang, *_ in rows)
    assert langid.learn(frame(spark, [])) is None and langid.learn(frame(spark, [(1, "a", None, None, None)])) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(frame(spark, []), None).count() == 0


def test_query_held_out_accuracy(spark):
    from tidemark.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op1_byte_cnn_language"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
