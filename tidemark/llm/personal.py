"""Personal data in texts: candidates that labelers vote on, reliabilities by expectation maximisation, a span classifier.

Kinds are email, ip, card and phone. What a kind's expression matches and its check passes is a *base* span;
these always stay. Other candidates look alike without being base spans: matches that fail their check, 13 to 15 card
digits, addresses written with (at) and (dot), hosts without a dot, IPv6, national phone numbers and those that begin with
00. One that overlaps a base span of any kind is no candidate.

Each of six labelers says yes, no or nothing of every candidate: the strict form, the layout, a gazetteer (top-level
domains, card issuers, country codes, reserved networks), words before it, the characters around it, and how much its
digits vary. Spark counts the candidates of every pattern of votes, over all documents: at most 3**6 rows a kind,
whatever the size. From these counts expectation maximisation estimates how often each labeler says what of true and
of false candidates, and so each pattern's probability. That probability, not a label, is what a logistic curve over
FLAGS yes-or-no properties of a candidate learns, again from counts (2**FLAGS rows a kind at most). It names the
added spans: candidates of one half or more, from left to right, that overlap no span added before. A kind whose labelers
never say both yes and no of its candidates has nothing to learn from, and adds none.

All searches are linear in the text: runs of letters or digits are tried once, not from every place in them. Candidates
travel, texts do not. Null and empty texts have no spans; rows with a null or repeated doc_id are rows like others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stage
from tidemark.llm.words import slices

KINDS = ("email", "ip", "card", "phone")

# The contract's expressions, written so that a run of characters is tried once. Matches are the same: an
# address begins at the first of its run, or behind the match before; a run of digits that fails from its first digit fails from all.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Forms beside the base ones.
DIGIT = re.compile(r"[0-9]")
HOST = re.compile(r"[A-Za-z0-9-]+")
AT = re.compile(r"\x20?[(\[{]\x20?at\x20?[)\]}]\x20?|\x20at\x20", re.I)
SPOKEN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){1,5}", re.I)
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
NATIONAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
ABROAD = re.compile(r"(?<![0-9+])00[1-9][\x20().0-9-]{6,18}[0-9](?![0-9])")

# Gazetteers.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co de fr es it uk us eu nl ch at be pl ru cn jp in br mx ar ca au se no dk fi pt gr cz tr kr za nz ie example".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "2", "34", "37", "6011", "65", "35", "36", "30", "38", "62")
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "5", "6", "8", "90", "91", "92", "93", "94", "95", "98")
OWN_NETWORKS = ("0.", "127.", "255.")
SAYS_YES = {
    "email": re.compile(r"\b(e-?mails?|mail|contact|write|reach|address|correo|courriel|kontakt)\b", re.I),
    "ip": re.compile(r"\b(ip|ipv4|ipv6|host|server|address|client|login|from|adresse)\b", re.I),
    "card": re.compile(r"\b(card|visa|mastercard|amex|credit|debit|payment|karte|tarjeta|carte)\b", re.I),
    "phone": re.compile(r"\b(phone|call|tel|telephone|mobile|cell|fax|telefon|tel[eé]fono|t[eé]l[eé]phone|whatsapp)\b", re.I),
}
SAYS_NO = re.compile(r"\b(version|release|section|order|invoice|isbn|issn|serial|ticket|sku|part|ref|revision|chapter|figure|build|tracking)\b", re.I)

#: Characters before a candidate in which the labeler of words looks.
CONTEXT = 48
LABELERS, FLAGS = 6, 12
#: Runs of expectation maximisation and of the classifier's Newton steps at most; both end when they stand still.
ROUNDS, STEPS = 500, 50


@dataclass
class Candidate:
    kind: int
    start: int
    end: int
    base: bool
    form: int  # 0 the base expression, further ones by kind
    text: str


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int, int]]:
    behind = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            found = DOMAIN.match(text, at + 1)
            host = None if found else HOST.match(text, at + 1)
            if found or host:
                end = (found or host).end()
                yield start, end, 0 if found else 1
                behind = end if found else behind
        behind = max(behind, at + 1)  # a run of letters ends at the sign
        at = text.find("@", max(at + 1, behind))


def _spoken(text: str) -> Iterator[tuple[int, int, int]]:
    """Addresses with a word in place of the sign."""
    for sign in AT.finditer(text):
        start = sign.start()
        while start > max(0, sign.start() - 64) and text[start - 1] in LOCAL:
            start -= 1
        found = SPOKEN.match(text, sign.end()) if start < sign.start() else None
        # without brackets, both words have to be there
        if found and (sign.group().strip().lower() != "at" or " dot " in found.group().lower()):
            yield start, found.end(), 2


def candidates(text: str) -> list[Candidate]:
    """Base spans, and candidates that overlap none of them, of one text; each kind in order of its starts."""
    found: list[Candidate] = []

    def add(kind: int, start: int, end: int, base: bool, form: int) -> None:
        found.append(Candidate(kind, start, end, base, form, text[start:end]))

    if "@" in text:
        for start, end, form in _emails(text):
            add(0, start, end, form == 0, form)
    for start, end, form in _spoken(text):
        add(0, start, end, False, form)
    digit = DIGIT.search(text)
    if digit is None and text.count(":") < 7:
        return _apart(found)
    begin = max(0, digit.start() - 2) if digit else len(text)  # a bracket or sign may precede the first one
    for m in IP.finditer(text, begin):
        add(1, *m.span(), all(_octet(x) for x in m.group().split(".")), 0)
    if text.count(":") >= 7:
        for m in IPV6.finditer(text):
            add(1, *m.span(), False, 1)
    for m in CARD.finditer(text, begin):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19:
                add(2, *m.span(), luhn(digits), 0)
            elif 13 <= len(digits) <= 15:
                add(2, *m.span(), False, 1)
    if "+" in text:
        for m in PHONE.finditer(text, begin):
            add(3, *m.span(), 8 <= len(_digits(m.group())) <= 15, 0)
    for m in NATIONAL.finditer(text, begin):
        add(3, *m.span(), False, 1)
    for m in ABROAD.finditer(text, begin):
        add(3, *m.span(), False, 2)
    return _apart(found)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _apart(found: list[Candidate]) -> list[Candidate]:
    base = sorted((c for c in found if c.base), key=lambda c: c.start)
    if len(base) < len(found) and base:
        starts = [c.start for c in base]
        ends = np.maximum.accumulate([c.end for c in base])
        at = np.searchsorted(starts, [c.end for c in found]) - 1  # last base span that begins before its end
        found = [c for c, k in zip(found, at.tolist(), strict=True) if c.base or k < 0 or ends[k] <= c.start]
    return sorted(found, key=lambda c: (c.kind, c.start, c.form))


def votes(c: Candidate, text: str) -> list[int]:
    """What each labeler says of a candidate: 1 yes, -1 no, 0 nothing."""
    digits = _digits(c.text)
    before = text[max(0, c.start - CONTEXT) : c.start]
    strict = 1 if c.base else -1 if c.form == 0 else 0
    if c.kind == 2 and not c.base:
        strict = 1 if luhn(digits) else -1
    return [strict, _layout(c, digits), _gazetteer(c, digits), _words(c.kind, before), _around(c, text), _variety(c, digits)]


def _layout(c: Candidate, digits: str) -> int:
    """Groups as people write them."""
    if c.kind == 0:
        return 1 if "." in c.text or "dot" in c.text.lower() else -1
    if c.kind == 1:
        return 1 if c.form or all(len(x) <= 3 and _octet(x) for x in c.text.split(".")) else -1
    groups = [len(x) for x in re.split(r"[^0-9]+", c.text) if x]
    if c.kind == 2:
        return 1 if len(groups) == 1 or groups[:-1] == [4] * (len(groups) - 1) or groups in ([4, 6, 5], [4, 6, 4]) else -1
    return 1 if 8 <= len(digits) <= 15 and max(groups) <= 10 else -1


def _gazetteer(c: Candidate, digits: str) -> int:
    if c.kind == 0:
        return 1 if re.split(r"[^A-Za-z0-9-]+", c.text.rstrip(")]} "))[-1].lower() in TOP_DOMAINS else -1
    if c.kind == 1:
        return 0 if c.form else -1 if c.text.startswith(OWN_NETWORKS) or not c.base else 1
    if c.kind == 2:
        return 1 if digits.startswith(ISSUERS) else -1
    return 0 if c.form == 1 else 1 if digits.lstrip("0").startswith(CALLING) else -1


def _words(kind: int, before: str) -> int:
    yes = max((m.end() for m in SAYS_YES[KINDS[kind]].finditer(before)), default=-1)
    no = max((m.end() for m in SAYS_NO.finditer(before)), default=-1)
    return 0 if yes == no else 1 if yes > no else -1


def _around(c: Candidate, text: str) -> int:
    """Standing by itself, or inside something longer."""
    left, right = text[c.start - 1 : c.start], text[c.end : c.end + 1]
    inside = (left.isalnum() or left in tuple("_/=#&\"'")) + (right.isalnum() or right in tuple("_/=#&\"'"))
    return -1 if inside else 1


def _variety(c: Candidate, digits: str) -> int:
    if c.kind < 2:
        return 0
    steps = {(int(b) - int(a)) % 10 for a, b in zip(digits, digits[1:], strict=False)}
    return -1 if len(set(digits)) <= 2 or len(steps) == 1 else 1


def flags(c: Candidate, text: str, said: list[int]) -> int:
    """FLAGS properties of a candidate as bits."""
    bits = [c.form == 1, c.form == 2, c.base, said[0] > 0, said[0] < 0, said[1] > 0, said[2] > 0, said[3] > 0, said[3] < 0, said[4] > 0, said[5] < 0]
    bits.append(any(x in c.text for x in " -()") if c.kind else len(c.text) > 40)
    return sum(1 << k for k, bit in enumerate(bits) if bit)


_FOUND = pa.list_(pa.struct([("kind", pa.int8()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.int32()), ("flags", pa.int32())]))
_FOUND_SQL = "found array<struct<kind: tinyint, start: int, end: int, base: boolean, votes: int, flags: int>>"


def pattern(said: list[int]) -> int:
    return sum((v + 1) * 3**k for k, v in enumerate(said))


def _find(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text"):
            rows = []
            for text in part.column("_text").to_pylist():
                row = []
                for c in candidates(text) if text else ():
                    said = votes(c, text)
                    row.append({"kind": c.kind, "start": c.start, "end": c.end, "base": c.base, "votes": pattern(said), "flags": flags(c, text, said)})
                rows.append(row)
            yield pa.RecordBatch.from_arrays([*(part.column(x) for x in keep), pa.array(rows, _FOUND)], [*keep, "found"])


@dataclass
class Reliability:
    """What a kind's labelers say: ``says[y, k, v]`` is the chance that labeler k votes v - 1 of a candidate that is (y = 1) or is
    not (y = 0) of its kind."""

    share: float = 0.5
    says: np.ndarray = field(default_factory=lambda: np.full((2, LABELERS, 3), 1 / 3))

    def chance(self, said: np.ndarray) -> np.ndarray:
        """Probability that candidates of these votes (rows of -1, 0, 1) are of the kind."""
        logs = [np.log(self.says[y][np.arange(LABELERS), said + 1]).sum(1) for y in (0, 1)]
        odds = logs[1] - logs[0] + np.log(self.share) - np.log1p(-self.share)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def reliabilities(said: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> Reliability:
    """Expectation maximisation over vote patterns and how often each occurs.

    Begins with the majority of each pattern. A labeler starts with two votes on the side of the truth, one on the other and
    one for silence, so that few candidates do not turn it around.
    """
    prior = np.ones((2, LABELERS, 3))
    prior[0, :, 0] = prior[1, :, 2] = 2.0
    p = 1 / (1 + np.exp(-1.5 * said.sum(1)))
    out = Reliability()
    for _ in range(rounds):
        for y, weight in ((0, n * (1 - p)), (1, n * p)):
            counts = prior[y].copy()
            for v in (-1, 0, 1):
                counts[:, v + 1] += ((said == v) * weight[:, None]).sum(0)
            out.says[y] = counts / counts.sum(1, keepdims=True)
        out.share = float(((n * p).sum() + 1) / (n.sum() + 2))
        before, p = p, out.chance(said)
        if np.abs(p - before).max(initial=0) < 1e-9:
            break
    return out


def unpacked(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3**k % 3 - 1 for k in range(LABELERS)], 1) if len(patterns) else np.empty((0, LABELERS), int)


def curve(bits: np.ndarray, n: np.ndarray, yes: np.ndarray, steps: int = STEPS, weight: float = 1.0) -> np.ndarray:
    """Weights of a logistic curve over flags (and a constant, last) from ``n`` candidates of each pattern of flags, of which
    ``yes`` are expected to be true; Newton's method with a squared penalty."""
    x = np.hstack([(bits[:, None] >> np.arange(FLAGS)) & 1, np.ones((len(bits), 1))]).astype(float)
    w = np.zeros(FLAGS + 1)
    penalty = np.full(FLAGS + 1, weight)
    penalty[-1] = 1e-3 * weight
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * p - yes) + penalty * w
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    """Reliabilities and span classifier of each kind that has any."""

    reliable: dict[int, Reliability]
    weights: dict[int, np.ndarray]

    def chance(self, kind: int, bits: int) -> float:
        w = self.weights.get(kind)
        if w is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(w[-1] + sum(w[k] for k in range(FLAGS) if bits >> k & 1), -500, 500))))


def find(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` (of other names than found, spans and _text) and the candidates of each row, with votes and flags."""
    ship(docs.sparkSession)
    types = [f"{x} {docs.schema[x].dataType.simpleString()}" for x in keep]
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(lambda it: _find(it, list(keep)), ", ".join([*types, _FOUND_SQL]))


def learn(found: DataFrame) -> Model:
    """Model of all candidates of a corpus, from counts alone."""
    one = found.select(F.explode("found").alias("c")).select("c.*")
    counts = one.groupBy("kind", "votes", "flags").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "votes")
    by_votes = counts.groupBy("kind", "votes").agg(F.sum("n").alias("n")).toArrow()  # 3**6 rows a kind at most
    reliable, rows = {}, []
    for kind in range(len(KINDS)):
        own = by_votes["kind"].to_numpy() == kind
        patterns, n = by_votes["votes"].to_numpy()[own], by_votes["n"].to_numpy()[own].astype(float)
        said = unpacked(patterns)
        if len(patterns) and (said > 0).any() and (said < 0).any():
            order = np.argsort(patterns)
            reliable[kind] = reliabilities(said[order], n[order])
            rows += [(kind, int(v), float(p)) for v, p in zip(patterns, reliable[kind].chance(said), strict=True)]
    chances = found.sparkSession.createDataFrame(rows, "kind tinyint, votes int, p double")
    by_flags = counts.join(chances, ["kind", "votes"]).groupBy("kind", "flags").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("yes")).toArrow()
    weights = {}
    for kind in reliable:
        own = by_flags["kind"].to_numpy() == kind
        bits, n, yes = (by_flags[x].to_numpy()[own] for x in ("flags", "n", "yes"))
        order = np.argsort(bits)
        weights[kind] = curve(bits[order], n[order].astype(float), yes[order])
    return Model(reliable, weights)


def _chosen(row: list[dict], model: Model) -> list[dict]:
    """Base spans and the added ones of a text, by kind and start."""
    added, behind = [], -1
    for c in sorted((c for c in row if not c["base"]), key=lambda c: (c["start"], -c["end"])):
        if c["start"] >= behind and model.chance(c["kind"], c["flags"]) >= 0.5:
            added.append(c)
            behind = c["end"]
    return sorted([c for c in row if c["base"]] + added, key=lambda c: (c["kind"], c["start"]))


def _name(spans: list[dict]) -> list[dict]:
    return [{"kind": KINDS[c["kind"]], "start": c["start"], "end": c["end"], "base": c["base"]} for c in spans]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def _label(batches: Iterator[pa.RecordBatch], model: Model, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_name(_chosen(row, model)) if row else [] for row in batch.column("found").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.array(rows, _SPANS)], [*keep, "spans"])


def spans(docs: DataFrame, *keep: str) -> tuple[DataFrame, Model]:
    """``keep`` and the spans (kind, start, end, base) of each row's text by kind and start, and the model that added some."""
    found = stage(find(docs, *keep), "candidates")
    model = learn(found)
    types = [f"{x} {docs.schema[x].dataType.simpleString()}" for x in keep]
    schema = ", ".join([*types, "spans array<struct<kind: string, start: int, end: int, base: boolean>>"])
    return found.mapInArrow(lambda it: _label(it, model, list(keep)), schema), model


def listed(column: str) -> F.Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(column, lambda c: F.concat_ws(":", c["kind"], c["start"], c["end"])), ",")


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, base spans of each kind, sha-256 of the base spans, and all spans, of rows with ``spans``."""
    base = rows.withColumn("base", F.filter("spans", lambda c: c["base"]))
    counts = [F.expr(f"CAST(size(filter(base, c -> c.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}") for kind in KINDS]
    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    return base.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"), added)


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [redact(t, f) for t, f in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def redacted(docs: DataFrame) -> DataFrame:
    """doc_id and text of each row, its spans replaced by their kinds."""
    rows, _ = spans(docs, "doc_id", "text")
    return rows.mapInArrow(_redact, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string")


def redact(text: str | None, found: list[dict]) -> str | None:
    """A text with each span replaced by its kind in angle brackets."""
    if text is None or not found:
        return text
    out, at = [], 0
    for c in sorted(found, key=lambda c: (c["start"], -c["end"])):
        if c["start"] >= at:
            out += [text[at : c["start"]], f"<{c['kind']}>"]
        at = max(at, c["end"])
    return "".join([*out, text[at:]])
