"""Licence notices in texts, found with a positional index of rare words.

1. For every word of the templates the documents that hold it are counted over the whole corpus; the fewer,
   the higher its weight (inverse document frequency).
2. The index holds, of each template, the postings (template, place) of its words of highest weight.
3. All words a document shares with the index are looked up; the index is bounded by the templates. A word
   at place p with a posting at place q lines the template up at p - q; postings are intersected by
   this relative place, and a template is a candidate where two or more of its places agree.
4. A candidate is verified: one of the template's key phrases has to stand inside it, word by word, and
   the weights of the words at their places have to reach ``AGREE`` of the template's. Where they do not, words may have
   been put in or left out: the heaviest common sequence of the template and the words around, ``GAP`` more on either side,
   has to reach it instead, unless the same template was found there already. Notices are listed by place, the longer
   first where two begin together.

Words are runs of 0-9, a-z (A-Z made small) and non-ASCII characters. Phrases of ``PHRASES`` give the base
labels wherever they stand; templates add labels of their own. The score is the best share of a verified
template, or 0. Null and wordless texts have no words, labels or places and score 0. Rows without an id
are scanned like others; repeated rows are scanned each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.words import NOT_ALNUM, Words, slices, words_of

#: Phrases and the labels they give.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, notice, and key phrases of which one is mandatory.
TEMPLATES = [
    ("mit-notice", "Released under the MIT License.", ["mit license"]),
    ("mit-notice", "Licensed under the MIT License.", ["mit license"]),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", ["apache license version 2 0"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", ["apache license version 2 0"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", ["general public license version 3"]),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2", ["general public license"]),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", ["lesser general public license"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ["cc by nc 4 0"]),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ["creative commons attribution 4 0"]),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["creative commons attribution sharealike 4 0"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["mozilla public license"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify and or distribute this software"]),
    ("unlicense", "This is free and unencumbered software released into the public domain.", ["free and unencumbered software"]),
    ("all-rights-reserved", "All rights reserved. No part of this work may be reproduced without written permission", ["all rights reserved"]),
]

#: Words of a template in the index, at most; half of its distinct words where that is fewer.
INDEXED = 8
AGREE = 0.8
#: Words by which a notice may be displaced within itself.
GAP = 4
RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
    " notices array<struct<label:string, start:int, n_words:int, share:double>>"
)
_NOTICES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("n_words", pa.int32()), ("share", pa.float64())]))


def _words(text: str) -> np.ndarray:
    return words_of(pa.array([text]), lower=True, apart=NOT_ALNUM).hashes()


@dataclass
class Index:
    """Templates as fingerprints of words, their words' weights, and postings of the indexed words."""

    templates: list[np.ndarray]
    phrases: list[list[np.ndarray]]
    weights: list[np.ndarray]
    words: np.ndarray  # indexed words, ascending
    postings: list[np.ndarray]  # of each: rows (template, place)

    @classmethod
    def build(cls, weight: dict[int, float], templates=TEMPLATES) -> "Index":
        texts = [_words(t) for _, t, _ in templates]
        weights = [np.array([weight[int(w)] for w in t]) for t in texts]
        postings: dict[int, list[tuple[int, int]]] = {}
        for k, (text, own) in enumerate(zip(texts, weights, strict=True)):
            distinct = sorted(set(text.tolist()), key=lambda w: (-weight[w], w))
            chosen = set(distinct[: max(2, min(INDEXED, len(distinct) // 2))])
            for place, word in enumerate(text.tolist()):
                if word in chosen:
                    postings.setdefault(word, []).append((k, place))
        words = np.array(sorted(postings), np.uint64)
        return cls(texts, [[_words(p) for p in ps] for _, _, ps in templates], weights, words, [np.array(postings[w], np.int64) for w in words.tolist()])


def _places(prints: np.ndarray, words: Words, phrase: np.ndarray) -> np.ndarray:
    """Where the words of a phrase stand consecutively in one document."""
    at = np.flatnonzero(prints == phrase[0])
    at = at[at + len(phrase) <= len(prints)]
    for k in range(1, len(phrase)):
        at = at[prints[at + k] == phrase[k]]
    return at[words.doc[at] == words.doc[at + len(phrase) - 1]] if len(at) else at


def _candidates(prints: np.ndarray, words: Words, index: Index) -> np.ndarray:
    """Rows (template, first word of its place, may lie outside the document; document) where two or more postings agree."""
    at = np.minimum(np.searchsorted(index.words, prints), len(index.words) - 1)
    found = np.flatnonzero(index.words[at] == prints)
    word, doc = at[found], words.doc[found]
    rows = [np.empty((0, 3), np.int64)]
    for w in np.unique(word).tolist():
        here = word == w
        for template, place in index.postings[w].tolist():
            rows.append(np.stack([np.full(here.sum(), template), found[here] - place, doc[here]], axis=1))
    rows, votes = np.unique(np.concatenate(rows), axis=0, return_counts=True)
    return rows[votes >= 2]


def _common(text: np.ndarray, weight: np.ndarray, window: np.ndarray) -> tuple[float, int]:
    """Weight of the heaviest common sequence of words, and the words of the window up to its end."""
    best = np.zeros(len(window) + 1)
    for word, w in zip(text, weight, strict=True):
        longer = np.where(window == word, best[:-1] + w, 0)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], longer))
    return float(best[-1]), int(np.argmax(best == best[-1]))


def _scan(batches: Iterator[pa.RecordBatch], index: Index, labels: list[str]) -> Iterator[pa.RecordBatch]:
    phrases = [(_words(p), label) for p, label in PHRASES.items()]
    for batch in batches:
        for part in slices(batch, "text"):
            words = words_of(part.column("text"), lower=True, apart=NOT_ALNUM)
            prints, n = words.hashes(), len(part)
            count, low, high = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base: list[set[str]] = [set() for _ in range(n)]
            for phrase, label in phrases:
                at = _places(prints, words, phrase)
                doc = words.doc[at]
                np.add.at(count, doc, 1)
                np.minimum.at(low, doc, at - words.first[doc])
                np.maximum.at(high, doc, at - words.first[doc])
                for d in np.unique(doc).tolist():
                    base[d].add(label)
            score, notices = np.zeros(n), [[] for _ in range(n)]
            known: dict[bytes, np.ndarray] = {}
            def phrase_inside(template: int, a: int, b: int) -> bool:
                for phrase in index.phrases[template]:
                    key = phrase.tobytes()
                    if key not in known:
                        known[key] = _places(prints, words, phrase)
                    i = np.searchsorted(known[key], a)
                    if i < len(known[key]) and known[key][i] + len(phrase) <= b:
                        return True
                return False

            def note(template: int, d: int, a: int, b: int, share: float) -> None:
                notices[d].append({"label": labels[template], "start": int(a - words.first[d]), "n_words": int(b - a), "share": share})
                score[d] = max(score[d], min(1.0, share))
                taken.setdefault((template, d), []).append((a, b))

            taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
            displaced = []
            for template, start, d in _candidates(prints, words, index).tolist() if len(prints) else ():
                text, weight = index.templates[template], index.weights[template]
                a, b = max(start, words.first[d]), min(start + len(text), words.first[d + 1])
                share = float(weight[a - start : b - start][prints[a:b] == text[a - start : b - start]].sum() / weight.sum())
                if share < AGREE:
                    displaced.append((template, d, max(start - GAP, words.first[d]), min(start + len(text) + GAP, words.first[d + 1])))
                elif phrase_inside(template, a, b):
                    note(template, d, a, b, share)
            for template, d, a, b in displaced:
                if any(x < b and a < y for x, y in taken.get((template, d), ())) or not phrase_inside(template, a, b):
                    continue
                text, weight = index.templates[template], index.weights[template]
                found, length = _common(text, weight, prints[a:b])
                if found >= AGREE * weight.sum():
                    end = a + length
                    begin = end - _common(text[::-1], weight[::-1], prints[a:end][::-1])[1]
                    if phrase_inside(template, begin, end):
                        note(template, d, begin, end, float(found / weight.sum()))
            own = [",".join(sorted(x)) for x in base]
            every = [",".join(sorted(x | {y["label"] for y in z})) for x, z in zip(base, notices, strict=True)]
            for found in notices:
                found.sort(key=lambda y: (y["start"], -y["n_words"]))
            none = count == 0
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words.counts), pa.array(count), pa.array(low, mask=none), pa.array(high, mask=none), pa.array(own), pa.array(every), pa.array(score), pa.array(notices, _NOTICES)],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"],
            )


def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Documents of a task that hold each word of the vocabulary, and documents in all (word -1)."""
    held, docs = np.zeros(len(vocabulary), np.int64), 0
    for batch in batches:
        for part in slices(batch, "text"):
            words = words_of(part.column("text"), lower=True, apart=NOT_ALNUM)
            prints = words.hashes()
            at = np.minimum(np.searchsorted(vocabulary, prints), len(vocabulary) - 1)
            found = np.flatnonzero(vocabulary[at] == prints)
            pairs = np.unique(words.doc[found] * len(vocabulary) + at[found])
            held += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
            docs += len(part)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(vocabulary)), pa.int64()), pa.array(np.append(docs, held))], ["word", "n"])


def weights(docs: DataFrame, templates=TEMPLATES) -> dict[int, float]:
    """Inverse document frequency, over all of ``docs``, of each word of the templates."""
    ship(docs.sparkSession)
    vocabulary = np.unique(np.concatenate([_words(t) for _, t, _ in templates]))
    counted = docs.select("text").mapInArrow(lambda it: _frequencies(it, vocabulary), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = {r["word"]: r["n"] for r in counted.collect()}
    return {int(w): float(np.log((n.get(-1, 0) + 2) / (n.get(k, 0) + 1))) for k, w in enumerate(vocabulary)}


def notices(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Per row of ``docs``: n_words, base places and labels, all labels, score, and the notices found."""
    index, labels = Index.build(weights(docs, templates), templates), [x for x, _, _ in templates]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: _scan(it, index, labels), RESULT)
