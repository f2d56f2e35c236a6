"""Secrets in texts: fixed patterns, and credential values that are costly to guess.

The base patterns find assigned keys, access key numbers and hexadecimal strings. Beyond them,
every value in a credential context (``pwd = ...``, ``passphrase: ...``) is priced as a guesser
would: dynamic programming over the value finds the cheapest way to cut it into dictionary
words, dates, repeats, sequences, keyboard walks and brute-force spans. A value of at least
``min_log10`` guesses is a secret; ``password: changeme`` is not. The dictionary is common parts of
passwords and then the words of the texts themselves, those in the most texts first, at most
``MOST_WORDS``; what stands as a credential's value is not counted, so a secret that is copied is no
word. A word in fewer than ``MIN_TEXTS`` texts is not known.

Defined results: a null or empty text has no spans. Spans count code points, ends are exclusive,
and are ordered by start, then kind as in KINDS. Rows are independent, so repeated rows give
equal rows and an empty table gives an empty table. All other columns pass through. Time and
memory grow in proportion to a text's length, also for values of any length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.frames import shipped, written
from reviewlab.llm.words import folded

KINDS = ("assign", "access", "hex", "guess")
SPAN = "array<struct<kind:string,start:int,end:int,log10_guesses:double>>"
ARROW_SPAN = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("log10_guesses", pa.float64()),
        ]
    )
)
MIN_LOG10 = 9.0
# Words learnt from the texts: how many at most, in how many texts at least, and their lengths.
MOST_WORDS, MIN_TEXTS, WORD_LENGTHS = 50_000, 3, (3, 20)

# The base patterns with the least length that counts.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18

# Words that name a credential, lower case.
CREDENTIALS = ("password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "apikey",
               "api_key", "api-key", "access_key", "private_key", "credential", "auth_key")
VALUE = re.compile(
    r"(?:" + "|".join(CREDENTIALS) + r")[\"']?[ \t]{0,8}(?:=>|:=|[:=])[ \t]{0,8}[\"']?"
    r"([^\s\"'<>,;]{6,})",
    re.IGNORECASE | re.ASCII,
)

# Common parts of passwords, most common first.
COMMON_WORDS = (
    "password pass admin welcome login master user test guest root qwerty letmein secret dragon "
    "monkey shadow sunshine princess football baseball superman batman iloveyou trustno hello "
    "freedom whatever ninja mustang access flower love hunter summer winter spring autumn "
    "monday friday january june july august change changeme default example sample dummy "
    "placeholder insert your here none null true false value key token server database system "
    "local public private company office computer internet google apple windows linux oracle "
    "mysql python java star king queen angel lucky happy cookie coffee orange banana purple "
    "yellow green blue black white silver gold tiger lion eagle wolf bear horse soccer hockey "
    "michael jessica daniel thomas robert jordan andrew joshua charlie maggie ashley the and"
).split()

# The rows of a keyboard.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("430157@$!", "aeoistasi")
DATE = re.compile(
    r"(?=((?:19|20)[0-9]{2}([-/._]?)(?:0[1-9]|1[0-2])\2(?:0[1-9]|[12][0-9]|3[01])"
    r"|(?:0[1-9]|[12][0-9]|3[01])([-/._]?)(?:0[1-9]|1[0-2])\3(?:19|20)[0-9]{2}"
    r"|(?:19|20)[0-9]{2}))"
)
LONGEST_PERIOD = 8
NEW_SEGMENT = math.log10(4)


def _neighbours() -> dict[str, frozenset[str]]:
    """Keys that touch each key: beside it in its row, or half a key off in the next rows."""
    place = {c: (2 * i + r, r) for r, row in enumerate(ROWS) for i, c in enumerate(row)}
    return {
        c: frozenset(
            d for d, (u, s) in place.items() if c != d and abs(r - s) <= 1 and abs(x - u) <= 2
        )
        for c, (x, r) in place.items()
    }


NEXT = _neighbours()
START_COST = math.log10(len(NEXT))
TURN_COST = math.log10(4.5)


def _class_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    if c.isascii() and c.isalpha():
        return math.log10(26)
    return math.log10(33) if c.isascii() else 2.0


class Guesser:
    """Prices values with a dictionary, in which a word's rank is its number of guesses."""

    def __init__(self, words: Sequence[str] = COMMON_WORDS):
        self.rank = {}
        for i, w in enumerate(words):
            self.rank.setdefault(w.lower(), i + 1)
        self.lengths = sorted({len(w) for w in self.rank if len(w) >= 3})

    def log10_guesses(self, value: str) -> float:
        """Cheapest segmentation of the whole value."""
        n = len(value)
        low = value.lower() if len(value.lower()) == n else value
        plain = low.translate(LEET)
        # closed[i]: value[:i] is cut into whole segments; brute[i]: a brute-force span is open
        closed, brute = [math.inf] * (n + 1), [math.inf] * (n + 1)
        closed[0] = 0.0
        dates = {m.start(): m.end(1) for m in DATE.finditer(low)}
        run, repeats = self._runs(low), self._repeats(low)
        for i in range(n):
            here = min(closed[i], brute[i])
            closed[i] = here
            step = _class_cost(value[i])
            brute[i + 1] = min(brute[i], closed[i] + NEW_SEGMENT) + step
            base = here + NEW_SEGMENT
            for length in self.lengths:
                if i + length > n:
                    break
                part = plain[i : i + length]
                rank = self.rank.get(part)
                if rank:
                    shape = 0.0 if value[i : i + length] == part else 0.6
                    self._offer(closed, i + length, base + math.log10(rank) + shape)
            if i in dates:
                self._offer(closed, dates[i], base + (4.0 if dates[i] - i > 4 else 2.0))
            for end, cost in run[i]:
                self._offer(closed, end, base + cost)
            # a block of a few characters repeated: the block by brute force, times the repeats
            for period, end in repeats[i]:
                block = sum(_class_cost(c) for c in value[i : i + period])
                self._offer(closed, end, base + block + math.log10((end - i) / period))
        return min(closed[n], brute[n])

    @staticmethod
    def _offer(closed: list[float], end: int, cost: float) -> None:
        if cost < closed[end]:
            closed[end] = cost

    def _runs(self, low: str) -> list[list[tuple[int, float]]]:
        """(end, cost) of the keyboard walks and sequences from every place: the longest one."""
        n = len(low)
        found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        walk, turns, seq = [1] * (n + 1), [0] * (n + 1), [1] * (n + 1)
        for i in range(n - 2, -1, -1):
            if low[i + 1] in NEXT.get(low[i], ()):
                walk[i] = walk[i + 1] + 1
                straight = i + 2 < n and ord(low[i + 1]) - ord(low[i]) == ord(low[i + 2]) - ord(
                    low[i + 1]
                )
                turns[i] = turns[i + 1] + (not straight and walk[i] > 2 and not self._row(low, i))
            delta = ord(low[i + 1]) - ord(low[i])
            if delta in (1, -1):
                same = i + 2 < n and ord(low[i + 2]) - ord(low[i + 1]) == delta
                seq[i] = seq[i + 1] + 1 if same else 2
            if walk[i] >= 3:
                cost = START_COST + (1 + turns[i]) * TURN_COST + math.log10(walk[i])
                found[i].append((i + walk[i], cost))
            if seq[i] >= 3:
                found[i].append((i + seq[i], 1.0 + math.log10(seq[i])))
        return found

    @staticmethod
    def _repeats(low: str) -> list[list[tuple[int, int]]]:
        """(period, end) of the repeated blocks from every place: the longest of each period."""
        n = len(low)
        found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for period in range(1, LONGEST_PERIOD + 1):
            same = 0
            for i in range(n - period - 1, -1, -1):
                same = same + 1 if low[i] == low[i + period] else 0
                if same >= period and same + period >= 3:
                    found[i].append((period, i + period * (same // period + 1)))
        return found

    @staticmethod
    def _row(low: str, i: int) -> bool:
        part = low[i : i + 3]
        return any(part in row or part in row[::-1] for row in ROWS)


def base_spans(text: str) -> list[tuple[int, int, int, float | None]]:
    """(start, rank of kind, end, None) of the base patterns."""
    out = []
    low = text.lower()
    if any(w in low for w in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_VALUE:
                out.append((m.start(), 0, m.end(), None))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LENGTH:
                out.append((m.start(), 1, m.end(), None))
    out.extend((m.start(), 2, m.end(), None) for m in HEX.finditer(text))
    return out


def spans(text: str | None, guesser: Guesser, min_log10: float = MIN_LOG10):
    """All spans of a text as (start, rank of kind, end, log10 of guesses or None), in order."""
    if not text:
        return []
    out = base_spans(text)
    low = text.lower()
    if any(w in low for w in CREDENTIALS):
        taken = sorted((s, e) for s, k, e, _ in out)
        at, reach = 0, 0
        for m in VALUE.finditer(text):
            start, end = m.span(1)
            while at < len(taken) and taken[at][0] <= start:
                reach = max(reach, taken[at][1])
                at += 1
            if reach >= end:
                continue  # one base span covers all of it
            cost = guesser.log10_guesses(m[1])
            if cost >= min_log10:
                out.append((start, 3, end, round(cost, 3)))
    return sorted(out, key=lambda x: x[:3])


def dictionary(df: DataFrame, text: str = "text", most: int = MOST_WORDS) -> list[str]:
    """The words in the most texts first, at most ``most``; words near the bound stay or go together."""
    prose = F.regexp_replace(F.coalesce(df[text], F.lit("")), "(?i)" + VALUE.pattern, " ")
    words = F.filter(F.split(folded(prose), r"\P{L}+"), lambda w: F.length(w).between(*WORD_LENGTHS))
    counts = df.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").count()
    level = F.floor(F.log2("count") * 8)
    counts = written(counts.filter(F.col("count") >= MIN_TEXTS).withColumn("level", level), "words")
    least, total = math.inf, 0
    for r in sorted(counts.groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True):
        total += r.n
        if total > most:
            break
        least = r.level
    if least == math.inf:
        return []
    kept = counts.filter(F.col("level") >= least).collect()
    return [r["word"] for r in sorted(kept, key=lambda r: (-r["count"], r["word"]))]


def scan(
    df: DataFrame,
    text: str = "text",
    out: str = "secrets",
    words: Sequence[str] | None = None,
    min_log10: float = MIN_LOG10,
) -> DataFrame:
    """Add the spans of every text, as an array of (kind, start, end, log10_guesses).

    ``words`` is the dictionary, most common first; by default the texts' own words are learnt.
    """
    words = [*COMMON_WORDS, *dictionary(df, text)] if words is None else list(words)

    @F.arrow_udf(SPAN)
    def find(column: pa.Array) -> pa.Array:
        guesser = Guesser(words)
        rows = []
        for value in column:
            rows.append(
                [
                    {"kind": KINDS[k], "start": s, "end": e, "log10_guesses": g}
                    for s, k, e, g in spans(value.as_py(), guesser, min_log10)
                ]
            )
        return pa.array(rows, ARROW_SPAN)

    return shipped(df).withColumn(out, find(df[text]))


def redact(df: DataFrame, text: str, spans_column: str, mask: str = "[SECRET]") -> DataFrame:
    """Replace every span of a text by ``mask``; spans that overlap are replaced together."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, f in zip(texts, found):
            f = f.as_py()
            at = [(x["start"], x["end"]) for x in f or ()]
            out.append(masked(t.as_py(), at, mask) if at else t.as_py())
        return pa.array(out, pa.string())

    hit = F.size(F.coalesce(df[spans_column], F.array())) > 0
    return shipped(df).withColumn(text, F.when(hit, clean(df[text], df[spans_column])).otherwise(df[text]))


def masked(text: str, at: list[tuple[int, int]], mask: str) -> str:
    parts, reach = [], 0
    for start, end in sorted(at):
        if start >= reach:
            parts += [text[reach:start], mask]
        reach = max(reach, end)
    return "".join([*parts, text[reach:]])
