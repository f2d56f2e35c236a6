"""Personal data by fixed patterns and a skip-chain conditional random field.

The base patterns (email, ip, card, phone) are always spans. Beyond them, every mention that
looks a little like one of these (a run with ``@``, a group of digits) is a node of a random
field over the labels none, email, ip, card and phone. Its edges are linear-chain edges between
neighbouring mentions and skip edges between mentions of a document that hold the same address or
end in the same digits; a skip edge goes to the next such mention only, so the number of edges is
below twice the number of mentions. Base mentions keep their label; loopy belief propagation
carries it over the edges, so that ``042 555 7845`` is a phone where ``+1 (042) 555-7845`` stands
in the same document.

The potentials are learnt by pseudo-likelihood on the mentions of a bounded sample of documents
(``max_documents``, smallest key hashes first), labelled by the base patterns. A share of the
mentions is shown in a damaged form that no base pattern finds, so the field learns what context
says about mentions it can't read.

Defined results: a null or empty text has no spans. Spans count code points, ends are exclusive,
ordered by kind as in KINDS, then start. Rows are independent, so repeated rows give equal rows
and an empty table gives an empty table; where no sampled document has a mention, only base spans
are found. All other columns pass through.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.frames import shipped

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"
ARROW_SPAN = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]
    )
)

# The base patterns. Possessive quantifiers and look-behinds keep them linear; they
# find what the plain forms find, as a match can begin at the start of a run only.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# What may be a mention beside the base spans: has an @, or six digits or more.
MENTION = re.compile(r"[^\s@,;<>()]{1,64}@[^\s@,;<>()]+|[+(]?[0-9](?:[ ().-]{0,2}[0-9])++")
MENTION_DIGITS = 6

MAX_DOCUMENTS = 4000
MAX_MENTIONS = 40_000
CHAIN_GAP = 80
SAME_DIGITS = 7
DAMAGED = 0.4
ROUNDS = 12
CLAMP = 50.0
# Numbers of the features; words before a mention are hashed.
WITH_AT, WITHOUT_AT = 1, 2
WORD_BUCKETS = 32
SHAPES = 18


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Leftmost non-overlapping matches, found from their ``@``."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        # an @ without a match ends the run before it; a match is left of what comes next
        free = m.end() if m else at + 1
        if m:
            yield start, m.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind, then start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label or -1) of the nodes of a text, by start."""
    found = [(s, e, k) for k, s, e in base]
    found.sort()
    taken, at, reach = [*found], 0, 0
    for m in MENTION.finditer(text):
        start, end = m.span()
        if "@" not in m[0] and sum("0" <= c <= "9" for c in m[0]) < MENTION_DIGITS:
            continue
        while at < len(found) and found[at][0] < end:
            reach = max(reach, found[at][1])
            at += 1
        if reach <= start:
            taken.append((start, end, -1))
    return sorted(taken)


def same_key(mention: str) -> str:
    """Mentions with equal keys are joined by skip edges."""
    if "@" in mention:
        return mention.lower().strip(".:")
    digits = _digits(mention)
    return digits if mention.count(".") == 3 else digits[-SAME_DIGITS:]


def features(text: str, start: int, end: int) -> list[int]:
    """Active features of a mention: its shape and the word before it."""
    m = text[start:end]
    d = _digits(m)
    word = text[max(0, start - 24) : start].split()
    shape = [
        0,
        WITH_AT if "@" in m else WITHOUT_AT,
        3 if m[:1] == "+" else 4,
        5 if "(" in m else 6,
        7 if m.count(".") == 3 else 8,
        9 if luhn(d) else 10,
        11 + min(5, max(0, len(d) - 5) // 3),
        17 if " " in m or "-" in m else 0,
    ]
    before = zlib.crc32(word[-1].lower().encode("utf-8", "replace")) if word else 0
    return [*dict.fromkeys(shape), SHAPES + before % WORD_BUCKETS]


def damage(text: str, start: int, end: int, kind: int) -> list[int]:
    """Features of a mention as it would look when no base pattern finds it."""
    m = text[start:end]
    if kind == 0:
        broken = m.replace(".", " ")
    elif kind == 1:
        broken = m + "."
    elif kind == 2:
        broken = m[:-1] + str((int(m[-1]) + 1) % 10)
    else:
        broken = m.lstrip("+").replace("(", "").replace(")", "")
    return features(text[:start][-24:] + broken, min(start, 24), min(start, 24) + len(broken))


@dataclass
class Field:
    """Log-potentials of single labels by feature, of chain edges and of skip edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, phi, edges, skips, rounds: int = ROUNDS) -> np.ndarray:
        """Label probabilities of all nodes after ``rounds`` of loopy message passing.

        ``phi`` are the nodes' log-potentials, ``edges`` the node pairs, ``skips`` their kinds.
        All documents of a batch form one graph.
        """
        if not len(edges):
            return _softmax(phi)
        psi = np.where(skips[:, None, None], self.skip, self.chain)
        a, b = edges[:, 0], edges[:, 1]
        to_b = np.zeros((len(edges), LABELS))
        to_a = np.zeros((len(edges), LABELS))
        for _ in range(rounds):
            belief = self._gather(phi, a, b, to_a, to_b)
            new_b = _logsum((belief[a] - to_a)[:, :, None] + psi, 1)
            new_a = _logsum((belief[b] - to_b)[:, None, :] + psi, 2)
            to_b = 0.5 * to_b + 0.5 * (new_b - new_b.max(1, keepdims=True))
            to_a = 0.5 * to_a + 0.5 * (new_a - new_a.max(1, keepdims=True))
        return _softmax(self._gather(phi, a, b, to_a, to_b))

    @staticmethod
    def _gather(phi, a, b, to_a, to_b) -> np.ndarray:
        out = phi.copy()
        for label in range(LABELS):
            out[:, label] += np.bincount(a, to_a[:, label], len(phi))
            out[:, label] += np.bincount(b, to_b[:, label], len(phi))
        return out

    def spans(self, texts: list[str | None]) -> list[list[dict]]:
        """Base and added spans of every text."""
        base = [base_spans(t) if t else [] for t in texts]
        nodes, owner, phi, edges, skips = [], [], [], [], []
        for i, text in enumerate(texts):
            own = mentions(text, base[i]) if text else []
            if all(label >= 0 for _, _, label in own):
                continue  # nothing to decide
            first = len(nodes)
            for pair, skip in links(text, own):
                edges.append((first + pair[0], first + pair[1]))
                skips.append(skip)
            for start, end, label in own:
                score = self.unary[:, features(text, start, end)].sum(1)
                if label >= 0:
                    score = np.full(LABELS, -CLAMP)
                    score[label] = CLAMP
                phi.append(score)
            nodes += own
            owner += [i] * len(own)
        added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if nodes:
            p = self.beliefs(
                np.array(phi), np.array(edges, np.int64).reshape(-1, 2), np.array(skips, bool)
            )
            for i, (start, end, label), q in zip(owner, nodes, p):
                best = int(q.argmax())
                if label < 0 and best != NONE and q[best] >= 0.5:
                    added[i].append((best, start, end))
        out = []
        for b, more in zip(base, added):
            rows = [(k, s, e, True) for k, s, e in b] + [(k, s, e, False) for k, s, e in more]
            rows.sort()
            out.append(
                [{"kind": KINDS[k], "start": s, "end": e, "base": own} for k, s, e, own in rows]
            )
        return out


def links(text: str, nodes: list[tuple[int, int, int]]):
    """((node, later node), is a skip edge) of one document."""
    last: dict[str, int] = {}
    for i, (start, end, _) in enumerate(nodes):
        if i and start - nodes[i - 1][1] <= CHAIN_GAP:
            yield (i - 1, i), False
        key = same_key(text[start:end])
        if key in last:
            yield (last[key], i), True
        last[key] = i


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def base_field() -> Field:
    """The field that adds no span."""
    unary = np.zeros((LABELS, SHAPES + WORD_BUCKETS))
    unary[NONE, 0] = CLAMP
    return Field(unary, np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))


def examples(text: str) -> list[tuple[list[int], int, list[int], list[int]]]:
    """(features, label, labels of chain neighbours, labels of skip neighbours) of a document."""
    nodes = mentions(text, base_spans(text))
    labels = [NONE if label < 0 else label for _, _, label in nodes]
    near: list[tuple[list[int], list[int]]] = [([], []) for _ in nodes]
    for (i, j), skip in links(text, nodes):
        near[i][skip].append(labels[j])
        near[j][skip].append(labels[i])
    out = []
    for i, (start, end, label) in enumerate(nodes):
        draw = zlib.crc32(f"{start}:{end}:{len(text)}".encode()) % 100
        hidden = label >= 0 and draw < 100 * DAMAGED
        shape = damage(text, start, end, label) if hidden else features(text, start, end)
        chain, skip = near[i]
        if label < 0 and any(k != NONE for k in skip):
            continue  # the patterns say nothing about such a mention
        out.append((shape, labels[i], chain, skip))
        if hidden:  # the same damaged mention where nothing speaks for it
            out.append((shape, NONE, [NONE for _ in chain], [NONE for _ in skip]))
    return out


def learn(rows: list[tuple[list[int], int, list[int], list[int]]], steps: int = 300) -> Field:
    """Maximise the pseudo-likelihood of the labels given their neighbours' labels."""
    if not rows:
        return base_field()
    wide = SHAPES + WORD_BUCKETS
    x = np.zeros((len(rows), wide + 2 * LABELS))
    y = np.zeros(len(rows), np.int64)
    for i, (shape, label, chain, skip) in enumerate(rows):
        x[i, shape] = 1
        y[i] = label
        for k in chain:
            x[i, wide + k] += 1
        for k in skip:
            x[i, wide + LABELS + k] += 1
    target = np.eye(LABELS)[y]
    w = np.zeros((LABELS, x.shape[1]))
    momentum = np.zeros_like(w)
    for _ in range(steps):
        gradient = (_softmax(x @ w.T) - target).T @ x / len(x) + 1e-4 * w
        momentum = 0.9 * momentum + gradient
        w -= 0.5 * momentum
    chain, skip = w[:, wide : wide + LABELS], w[:, wide + LABELS :]
    w[0, WITHOUT_AT] -= CLAMP  # an address has an @, and nothing else does
    w[1:NONE, WITH_AT] -= CLAMP
    # an edge has one potential for both directions
    return Field(w[:, :wide], (chain + chain.T) / 2, (skip + skip.T) / 2)


def fit(
    df: DataFrame, key: str = "doc_id", text: str = "text", max_documents: int = MAX_DOCUMENTS
) -> Field:
    """Learn a field from at most ``max_documents`` documents that hold a mention."""
    rows = shipped(df).select(df[key].alias("key"), df[text].alias("text"))
    rows = rows.filter(F.col("text").rlike("[0-9]{4}|@"))
    chosen = rows.select("key").orderBy(F.xxhash64("key"), "key").limit(max_documents)
    sample = rows.join(F.broadcast(chosen.distinct()), "key", "left_semi")

    @F.arrow_udf("array<struct<shape:array<int>,label:int,chain:array<int>,skip:array<int>>>")
    def shown(column: pa.Array) -> pa.Array:
        names = ("shape", "label", "chain", "skip")
        out = [[dict(zip(names, e)) for e in examples(t.as_py() or "")] for t in column]
        ints = pa.list_(pa.int32())
        kind = pa.struct([("shape", ints), ("label", pa.int32()), ("chain", ints), ("skip", ints)])
        return pa.array(out, pa.list_(kind))

    shown_rows = sample.select("key", F.posexplode(shown(F.col("text"))).alias("n", "e"))
    picked = shown_rows.orderBy(F.xxhash64("key"), "key", "n").limit(MAX_MENTIONS).collect()
    return learn([(r.e.shape, r.e.label, r.e.chain, r.e.skip) for r in picked])


def scan(df: DataFrame, field: Field, text: str = "text", out: str = "pii") -> DataFrame:
    """Add the spans of every text, as an array of (kind, start, end, base)."""

    @F.arrow_udf(SPAN)
    def find(column: pa.Array) -> pa.Array:
        done = []
        for first in range(0, len(column), 500):
            done += field.spans(column.slice(first, 500).to_pylist())
        return pa.array(done, ARROW_SPAN)

    # texts without a digit and without @ have no span and don't go to Python
    return shipped(df).withColumn(
        out,
        F.coalesce(
            find(F.when(df[text].rlike("[0-9@]"), df[text])), F.array().cast(SPAN)
        ),
    )
