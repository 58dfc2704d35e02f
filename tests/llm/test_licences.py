import re

from cases import corpus, frame

from tidemark.llm import licences

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute(text):
    """Base columns of one text."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    places = [k for k, _ in at]
    return len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def brute_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_base_columns_and_notices(spark):
    rows = corpus(5)
    lines = [t for _, t, _ in licences.TEMPLATES]
    for k, line in enumerate(lines):
        rows.append((2000 + k, f"{rows[k][1] or ''}\n{line}\nmore words after", None, None, None))
    rows += [
        (3000, "MIT  License, mit-license. general\npublic\tLICENSE apache license", None, None, None),
        (3001, "the mit licenses and an apache's license", None, None, None),
        (3002, "license " * 500 + "mit", None, None, None),
        (3003, "Licensed under something else entirely 4.0.", None, None, None),
    ]
    got = licences.notices(frame(spark, rows).repartition(3)).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(((d, *brute(t)) for d, t, *_ in rows), key=key)
    by = {r.doc_id: r for r in got}
    for k, (label, line, _) in enumerate(licences.TEMPLATES):
        r = by[2000 + k]
        assert label in r.labels.split(",") and 0.8 <= r.score <= 1, (label, r)
        found = next(x for x in r.notices if x.label == label and x.share == 1)
        assert found.n_words == brute(line)[0]
    for d in (3002, 3003, 1002, 1001):
        assert by[d].score == 0 and by[d].labels == by[d].base_labels and not by[d].notices


def test_several_notices_and_long_texts_of_index_words(spark):
    names, lines = [x for x, _, _ in licences.TEMPLATES], [t for _, t, _ in licences.TEMPLATES]
    pairs = [(a, b) for a in range(len(lines)) for b in range(len(lines)) if names[a] != names[b]]
    rows = [(k, f"some text {lines[a]} between them {lines[b]} and after", None, None, None) for k, (a, b) in enumerate(pairs)]
    rows.append((5000, "\n".join(lines), None, None, None))
    loose = sorted({w for t in lines for w in t.split()})
    rows += [(6000 + k, f"{' word '.join(loose * 40)} {line} {' word '.join(loose)}", None, None, None) for k, line in enumerate(lines)]
    docs = frame(spark, rows).repartition(3)
    by = {r.doc_id: r for r in licences.notices(docs).collect()}
    for k, (a, b) in enumerate(pairs):
        assert {names[a], names[b]} <= set(by[k].labels.split(",")), (names[a], names[b], by[k].labels)
    assert set(names) <= set(by[5000].labels.split(","))
    for k, name in enumerate(names):
        assert any(x.label == name and x.share == 1 for x in by[6000 + k].notices), (name, by[6000 + k].notices)


def test_words_put_in_or_left_out(spark):
    """Each longer notice with words put in, or put in and left out, away from its key phrase, is found once; those whose
    places before or behind alone agree well enough are listed without the words on the other side."""
    rows, want = [], {}
    for k, (label, line, phrases) in enumerate(licences.TEMPLATES):
        words = line.split()
        if len(words) < 15:
            continue
        behind = {"gpl-2.0": 15, "lgpl": 15, "isc": 10}.get(label, 9)
        forms = {"in": words[:behind] + ["truly"] + words[behind:], "twice": words[:behind] + ["very", "truly"] + words[behind:], "both": words[:behind] + ["truly"] + words[behind:-3] + words[-2:]}
        for j, form in enumerate(forms.values()):
            text = " ".join(form)
            low = " ".join(brute_words(text))
            if not any(p in low for p in phrases):
                continue
            rows.append((10 * k + j, f"some words before\n{text}\nand some after it", None, None, None))
            want[10 * k + j] = (label, 3, brute(text)[0])
    rows.append((5000, " ".join(sorted({w for _, t, _ in licences.TEMPLATES for w in t.split()})) * 3, None, None, None))
    rows.append((5001, "license " * 30_000, None, None, None))
    by = {r.doc_id: r for r in licences.notices(frame(spark, rows)).collect()}
    assert len({label for label, *_ in want.values()}) >= 5
    for d, (label, start, n) in want.items():
        found = [(x.start, x.n_words) for x in by[d].notices if x.label == label]
        assert label in by[d].labels.split(",") and 0.8 <= by[d].score <= 1, (d, label, found)
        assert 1 <= len(found) <= [x for x, _, _ in licences.TEMPLATES].count(label), (d, label, found)
        at, length = max(found, key=lambda x: x[1])
        assert start <= at and at + length <= start + n and length >= n - 4, (d, label, found, n)
    assert by[5000].score == 0 and by[5001].score == 0


def test_empty_table(spark):
    assert licences.notices(frame(spark, [])).count() == 0


def test_query_base_columns(spark, sf_dir):
    from tidemark.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op9_rare_token_licences"](spark, sf_dir).collect()
    assert {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == {(d, *brute(t)) for d, t in rows}
