"""Personal data by weak supervision.

Strict patterns (the base) and looser ones propose spans.  Five labelers vote
on each: strict pattern, structural check, gazetteer, context words and edges.
Expectation maximisation over the counts of vote patterns estimates how often
each labeler votes for or against true and false spans, without labels; the
resulting probabilities train a logistic span classifier.  Base spans always
stay; the classifier decides on the others.  All counts cover all documents
and are grouped by votes and coarse features, so what the driver gets is
bounded by their number (``KINDS`` x 3^5 votes x features), not by the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import stage, text_of, unwrapped, wrapped

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")
#: A span that is not base is added from this probability on.
THRESHOLD = 0.95

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
SPOKEN_AT = re.compile(r" ?[(\[]at[)\]] ?")
SPOKEN_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)+")
# Guards and possessive runs keep these linear; they match as the plain patterns do, since a run of digits that fails
# from its start fails from everywhere in it.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+.)-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
DIGIT = re.compile("[0-9]")

#: Gazetteers: endings of domains, and calling codes.
ENDINGS = frozenset("com net org edu gov info biz io co uk de fr es it nl eu us ca au ch at be jp cn in br ru".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "82", "86", "90", "91", "351", "352", "353", "358", "420")
ISSUERS = re.compile(r"3[47]|4|5[1-5]|2[2-7]|6")
#: Words before a span that speak for or against a kind, in four languages.
CUES = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|correo|courriel|write to)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|adresse|dirección)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono|whatsapp)\b", re.I),
}
AGAINST = re.compile(r"\b(?:version|release|isbn|issn|order|invoice|token|hash|serial|section|chapter|license|part)\b", re.I)
CONTEXT = 40


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _octet(digits: str) -> int:
    """Value of a part, 1000 for all long ones."""
    digits = digits.lstrip("0")
    return int(digits or 0) if len(digits) < 4 else 1000


def _local_start(text: str, at: int, taken: int) -> int:
    """Start of the run of local characters before ``at``, not before ``taken``."""
    start = at
    while start > taken and text[start - 1] in LOCAL:
        start -= 1
    return start


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the strict patterns, by start, then by kind as listed."""
    found: list[tuple[int, int, str]] = []
    taken, at = 0, text.find("@")
    while at >= 0:
        start = _local_start(text, at, taken)
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            taken = domain.end()
            found.append((start, taken, "email"))
        at = text.find("@", max(at + 1, taken))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(_octet(p) <= 255 for p in m.group().split(".")):
                found.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((*m.span(), "card"))
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def loose_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Further proposals that overlap neither the base nor each other."""
    found: list[tuple[int, int, str]] = []
    for m in SPOKEN_AT.finditer(text):
        start = _local_start(text, m.start(), 0)
        domain = SPOKEN_DOMAIN.match(text, m.end()) if start < m.start() else None
        if domain:
            found.append((start, domain.end(), "email"))
    if ":" in text:
        found += [(*m.span(), "ip") for m in LOOSE_IP.finditer(text)]
    if DIGIT.search(text):
        found += [(*m.span(), "phone") for m in LOOSE_PHONE.finditer(text)]
        found += [(*m.span(), "card") for m in CARD.finditer(text) if 13 <= sum(c.isdigit() for c in m.group()) <= 19]
    end, kept, taken = 0, [], sorted((a, b) for a, b, _ in base)
    k = 0
    for span in sorted(found, key=lambda s: (s[0], KINDS.index(s[2]))):
        while k < len(taken) and taken[k][1] <= span[0]:
            k += 1
        if span[0] >= end and all(b <= span[0] for a, b in takewhile(lambda t, to=span[1]: t[0] < to, islice(taken, k, None))):
            kept.append(span)
            end = span[1]
    return kept


def votes(text: str, span: tuple[int, int, str], strict: bool) -> tuple[int, ...]:
    """Votes of the labelers: 1 for, -1 against, 0 none."""
    start, end, kind = span
    own = text[start:end]
    digits = "".join(c for c in own if c in "0123456789")
    if kind == "email":
        ending = re.split(r"[^A-Za-z0-9-]+", own.rstrip(")]"))[-1].lower()
        check, known = (1 if len(ending) > 1 and ending.isalpha() else -1), (1 if ending in ENDINGS else 0)
    elif kind == "ip":
        check = 1
        known = 1 if ":" in own or 0 < _octet(own.split(".")[0]) < 224 else -1
    elif kind == "card":
        check, known = (1 if 13 <= len(digits) <= 19 and _luhn(digits) else -1), (1 if ISSUERS.match(digits) else -1)
    else:
        check = 1 if 10 <= len(digits) <= 15 else -1
        known = (1 if digits.startswith(CALLING_CODES) else -1) if own[0] == "+" else 0
    before = text[max(0, start - CONTEXT):start]
    context = 1 if CUES[kind].search(before) else -1 if AGAINST.search(before) else 0
    edge = text[start - 1:start] + text[end:end + 1]
    return 1 if strict else 0, check, known, context, -1 if any(c.isalnum() or c in "_/=\"" for c in edge) else 1


def features(text: str, span: tuple[int, int, str]) -> tuple[int, int]:
    """Coarse shape: digits and separators, in a few steps."""
    own = text[span[0]:span[1]]
    digits = sum(c.isdigit() for c in own)
    return min(digits // 2, 10), min(sum(not c.isalnum() for c in own), 7)


def propose(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``proposals``: array of (kind, start, end, strict, votes, digits, separators)."""
    inner = [f"k{i}" for i in range(len(keep))]
    item = pa.struct([
        ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("strict", pa.bool_()),
        ("votes", pa.list_(pa.int32())), ("digits", pa.int32()), ("separators", pa.int32()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("t").to_pylist():
                base = base_spans(text)
                both = [(s, True) for s in base] + [(s, False) for s in loose_spans(text, base)]
                rows.append([
                    (KINDS.index(s[2]), s[0], s[1], strict, list(votes(text, s, strict)), *features(text, s)) for s, strict in both
                ])
            names = [f.name for f in item]
            rows = [[dict(zip(names, r, strict=True)) for r in row] for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in inner] + [pa.array(rows, pa.list_(item))], names=[*inner, "proposals"]
            )

    source = docs.select(*(F.col(c).alias(i) for c, i in zip(keep, inner, strict=True)), text_of().alias("t"))
    schema = ", ".join(f"{i} {docs.schema[c].dataType.simpleString()}" for c, i in zip(keep, inner, strict=True))
    out = source.mapInArrow(
        run, f"{schema}, proposals array<struct<kind:int,start:bigint,end:bigint,strict:boolean,votes:array<int>,digits:int,separators:int>>"
    )
    return out.select(*(F.col(i).alias(c) for c, i in zip(keep, inner, strict=True)), "proposals")


def estimate(ballots: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability that a proposal is true, for each ballot (row of votes) with its count, by EM.

    Starts from labelers that are right four times in five; pseudo-counts at these rates keep rare votes sane.
    """
    cast = np.stack([ballots == v for v in (-1, 0, 1)], 2).astype(float)  # ballot, labeler, vote
    prior_rates = np.array([[0.5, 0.3, 0.2], [0.1, 0.3, 0.6]])  # of votes -1, 0, 1 on false and on true spans
    rates = np.broadcast_to(prior_rates[:, None, :], (2, ballots.shape[1], 3)).copy()
    share = 0.5
    true = np.full(len(ballots), 0.5)
    for _ in range(rounds):
        logs = np.log(rates)
        odds = np.log(share / (1 - share)) + (cast * (logs[1] - logs[0])).sum((1, 2))
        true = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        for side, weight in enumerate((counts * (1 - true), counts * true)):
            seen = (cast * weight[:, None, None]).sum(0) + 10 * prior_rates[side]
            rates[side] = seen / seen.sum(1, keepdims=True)
        share = float(np.clip((counts @ true + 5) / (counts.sum() + 10), 0.01, 0.99))
    return true


def _design(kind: np.ndarray, ballots: np.ndarray, digits: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Classifier inputs: kind, votes of all labelers but the strict pattern, shape."""
    return np.concatenate([
        np.eye(len(KINDS))[kind], ballots[:, 1:] == 1, ballots[:, 1:] == -1, np.eye(11)[digits] / 2, np.eye(8)[separators] / 2,
    ], 1).astype(float)


def fit(proposals: DataFrame) -> np.ndarray:
    """Weights of the span classifier from the proposals of a corpus; zeros if there are none."""
    grouped = (
        proposals.select(F.explode("proposals").alias("p"))
        .groupBy("p.kind", "p.votes", "p.digits", "p.separators").agg(F.count("*").alias("n"))
        .orderBy("kind", "votes", "digits", "separators").collect()  # bounded by the combinations
    )
    if not grouped:
        return np.zeros(_design(*(np.zeros(s, int) for s in (1, (1, len(LABELERS)), 1, 1))).shape[1])
    kind, digits, separators, n = (np.array([r[c] for r in grouped]) for c in ("kind", "digits", "separators", "n"))
    ballots = np.array([r["votes"] for r in grouped])
    target = np.zeros(len(n))
    for k in range(len(KINDS)):
        if (own := kind == k).any():
            target[own] = estimate(ballots[own], n[own])
    inputs, weights = _design(kind, ballots, digits, separators), np.zeros(0)
    weights = np.zeros(inputs.shape[1])
    for _ in range(50):  # Newton steps on the penalised likelihood
        guess = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (n * (target - guess)) - weights
        bend = (inputs * (n * guess * (1 - guess))[:, None]).T @ inputs + np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights = weights + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def chosen(proposals: list[dict], weights: np.ndarray, threshold: float = THRESHOLD) -> list[dict]:
    """Base spans and the others that the classifier accepts, by start, then by kind as listed."""
    if not proposals:
        return []
    inputs = _design(*(np.array([p[c] for p in proposals]) for c in ("kind", "votes", "digits", "separators")))
    sure = 1 / (1 + np.exp(-np.clip(inputs @ weights, -50, 50))) >= threshold
    sure &= np.array([p["votes"][1] for p in proposals]) >= 0  # whatever was learned, a span that fails its check is none
    return sorted((p for p, s in zip(proposals, sure, strict=True) if p["strict"] or s), key=lambda p: (p["start"], p["kind"]))


def _listed(spans: list[dict]) -> str:
    return ",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in spans)


def decide(proposals: DataFrame, weights: np.ndarray) -> DataFrame:
    """Counts and hash of the base spans, and all spans (``doc_id``, ``proposals`` in).

    A text without spans has the hash of the empty string and empty ``spans``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for items in batch.column(1).to_pylist():
                base = sorted((p for p in items if p["strict"]), key=lambda p: (p["start"], p["kind"]))
                counts = [sum(p["kind"] == k for p in base) for k in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(chosen(items, weights))))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return proposals.select(F.col("doc_id").cast("long"), "proposals").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Personal data of all documents.  A missing text is empty; rows with equal ids are texts of their own."""
    proposals = stage(propose(docs, ["doc_id"]), "proposals")
    return decide(proposals, fit(proposals))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span of the text replaced by its kind in angle brackets; a missing text stays missing.

    ``n_chars``, where it is a column, follows the new text.
    """
    proposals = stage(propose(wrapped(docs), ["row", "text"]), "proposals")
    weights = fit(proposals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                text if text is None else replaced(text, chosen(items, weights))
                for text, items in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    row = proposals.schema["row"].dataType.simpleString()
    out = unwrapped(proposals.mapInArrow(run, f"row {row}, text string"), docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def replaced(text: str, spans: list[dict]) -> str:
    """The text with spans, in order, replaced by their kinds; of overlapping spans the first names all."""
    parts, at = [], 0
    for s in spans:
        if s["start"] >= at:
            parts += [text[at:s["start"]], f"<{KINDS[s['kind']]}>"]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]])
