"""SentencePiece BPE encoding and decoding with a given model, by vectorised merge rounds.

A text becomes symbols (one per code point, a space is U+2581, one space is put in front). No
piece of such a model holds U+2581 behind another character, so no merge crosses the place
before a run of U+2581: the text falls into words that are encoded apart. The distinct words
not met before are laid out in one flat symbol array and merged in rounds. A round finds every
word's best pair (the lowest rank, see ``Model``) and merges the pair's occurrences in all
words at once, then closes the gaps; words without a pair leave the array. Where merging one
occurrence could make a pair that is not worse than the one being merged, the word merges its
leftmost occurrence only, which is the order of the sequential algorithm.

Defined results: a null text gives no ids, like an empty one. Rows are independent, so repeated
rows give equal rows and an empty table gives an empty table. All other columns pass through.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from reviewlab.llm.arrays import flat_text, one_array, ranges, release, slices
from reviewlab.llm.frames import shipped

SPACE = "▁"
# Piece kinds of the model format that take part in merges, and the byte kind.
MERGING, BYTE = (1, 4, 5), 6
# A worker forgets the words met so far when they are more than this many, or as many characters.
KEPT_WORDS, KEPT_CHARS = 400_000, 8_000_000
# Fixed value: an odd multiplier that spreads keys over a hash table.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
NO_RANK = np.int64(1) << 40


class Model:
    """The pieces of a model: symbols, ranks and the table of pairs.

    Symbols are numbered: a piece by its id, a character that is no piece by ``len(pieces)`` plus
    its code point. A rank orders pieces by falling score; equal scores have equal ranks.
    """

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("a model with a space in front and no other normalisation is needed")
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        usable = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in MERGING}
        if any(SPACE in p.lstrip(SPACE) for p in usable):
            raise ValueError("a piece goes over a word's start")
        self.size = len(self.pieces)
        scores = np.array([p.score for p in proto.pieces])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.symbol = {p: i for p, i in usable.items() if len(p) == 1}
        # pieces of spaces only, by length; they have one score, below all others
        self.runs = {len(p): i for p, i in usable.items() if not p.strip(SPACE)}
        ranks = {int(self.rank[i]) for n, i in self.runs.items() if n > 1}
        self.run_rank = max(ranks, default=-1)
        if len(ranks) > 1 or ranks and self.run_rank < int(self.rank.max()):
            raise ValueError("pieces of spaces must have one score below all others")
        table = {}
        for piece, number in usable.items():
            for cut in range(1, len(piece)):
                left, right = self._symbol(piece[:cut], usable), self._symbol(piece[cut:], usable)
                if left is not None and right is not None:
                    table[(left << 32) | right] = number
        self._build(table)
        self.bytes = np.zeros(256, np.int64)
        raw = []
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds)):
            if k == BYTE:
                self.bytes[int(p[3:5], 16)] = i
                raw.append(bytes([int(p[3:5], 16)]))
            else:
                raw.append(p.replace(SPACE, " ").encode() if k in MERGING else b"")
        self.raw_at = np.cumsum([0, *map(len, raw)])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.known = Words()

    def _symbol(self, text: str, usable: dict[str, int]) -> int | None:
        found = usable.get(text)
        return self.size + ord(text) if found is None and len(text) == 1 else found

    def _build(self, table: dict[int, int]) -> None:
        """Lay the pairs out in a hash table of four times their number, with linear probing."""
        self.shift = np.uint64(64 - (4 * len(table)).bit_length())
        size = 1 << (64 - int(self.shift))
        self.pairs, self.merged = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        keys = np.fromiter(table, np.int64, len(table))
        for key, slot in zip(keys.tolist(), self._slot(keys).tolist()):
            while self.pairs[slot] >= 0:
                slot = (slot + 1) % size
            self.pairs[slot], self.merged[slot] = key, table[key]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged piece) of symbol pairs; NO_RANK where they don't merge."""
        key = (left << np.int64(32)) | right
        slot = self._slot(key)
        rank = np.full(len(key), NO_RANK)
        piece = np.zeros(len(key), np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            there = self.pairs[slot]
            same = there == key[open_]
            piece[open_[same]] = self.merged[slot[same]]
            rank[open_[same]] = self.rank[piece[open_[same]]]
            more = ~same & (there >= 0)
            open_, slot = open_[more], (slot[more] + 1) % len(self.pairs)
        return rank, piece

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of many words; ``word`` numbers the word of each and never falls."""
        done = []
        order = np.arange(len(symbols), dtype=np.int64)
        rank, piece = self._ranks(symbols, word, order)
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(symbols)))
            best = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            ended = best == NO_RANK
            if ended.any():
                done.append((symbols[ended], word[ended], order[ended]))
            runs = best == self.run_rank
            if runs.any():  # only runs of spaces are left to merge in these words
                done.append(self._merge_runs(symbols[runs], word[runs], order[runs]))
                ended |= runs
            if ended.any():
                on = ~ended
                symbols, word, order = symbols[on], word[on], order[on]
                rank, piece, best = rank[on], piece[on], best[on]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == best)
            # of hits that overlap (x x x), every second one counts, from the left
            run = np.flatnonzero(np.append(True, np.diff(hit) > 1))
            inside = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
            hit = hit[inside % 2 == 0]
            hit = self._safe(symbols, word, piece, best, hit)
            symbols[hit] = piece[hit]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, word, order = symbols[keep], word[keep], order[keep]
            rank, piece = rank[keep], piece[keep]
            now = hit - np.arange(len(hit))  # where the merged symbols stand now
            stale = np.concatenate([now, now[now > 0] - 1])
            rank[stale], piece[stale] = self._ranks(symbols, word, stale)
        if not done:
            return symbols, word
        symbols, word, order = (np.concatenate(x) for x in zip(*done))
        back = np.argsort(order, kind="stable")
        return symbols[back], word[back]

    def _ranks(self, symbols, word, at):
        """(rank, merged piece) of the pairs that begin at some places; none over a word's end."""
        rank = np.full(len(at), NO_RANK)
        piece = np.zeros(len(at), np.int64)
        after = np.minimum(at + 1, len(symbols) - 1)
        inner = np.flatnonzero((at + 1 < len(symbols)) & (word[at] == word[after]))
        rank[inner], piece[inner] = self.look_up(symbols[at[inner]], symbols[after[inner]])
        return rank, piece

    def _merge_runs(self, symbols, word, order):
        """Merge the runs of spaces in words in which no other pair merges."""
        lead = np.flatnonzero(symbols == self.symbol[SPACE])
        cut = (np.diff(lead) > 1) | (np.diff(word[lead]) > 0)
        starts = np.flatnonzero(np.append(True, cut))
        lengths = np.diff(np.append(starts, len(lead)))
        keep = np.ones(len(symbols), bool)
        for at, k in zip(lead[starts].tolist(), lengths.tolist()):
            pieces = self._run(k)
            symbols[at : at + len(pieces)] = pieces
            keep[at + len(pieces) : at + k] = False
        return symbols[keep], word[keep], order[keep]

    def _run(self, k: int) -> list[int]:
        """The pieces of k spaces: always the leftmost two that make a piece."""
        sizes, at = [1] * min(k, 2), 0
        left = k - len(sizes)
        while True:
            if at + 1 < len(sizes) and sizes[at] + sizes[at + 1] in self.runs:
                sizes[at : at + 2] = [sizes[at] + sizes[at + 1]]
                at = max(at - 1, 0)
            elif at + 1 < len(sizes):
                at += 1
            elif left:
                sizes.append(1)
                left -= 1
            else:
                return [self.runs[n] for n in sizes]

    def _safe(self, symbols, word, piece, best, hit) -> np.ndarray:
        """Of several hits in a word, the leftmost only if a merge could make a pair no worse."""
        of = word[hit]
        first = np.append(True, of[1:] != of[:-1])
        if first.all():
            return hit
        many = ~first | np.append(~first[1:], False)
        some, old = hit[many], hit
        hit, of, last = some, of[many], len(symbols) - 1
        new, rank = piece[hit], best[hit]
        before, after = np.maximum(hit - 1, 0), np.minimum(hit + 2, last)
        has_before = (hit > 0) & (word[before] == of)
        has_after = (hit + 2 <= last) & (word[after] == of)
        touching = np.append(False, (hit[1:] == hit[:-1] + 2) & (of[1:] == of[:-1]))
        earlier = np.append(0, new[:-1])
        risky = has_before & (self.look_up(symbols[before], new)[0] <= rank)
        risky |= has_after & (self.look_up(new, symbols[after])[0] <= rank)
        risky |= touching & (self.look_up(earlier, new)[0] <= rank)
        risky |= touching & (self.look_up(earlier, symbols[hit])[0] <= rank)
        if not risky.any():
            return old
        return old[first | ~np.isin(word[old], np.unique(of[risky]))]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and how many each word has."""
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        distinct, where = np.unique(code, return_inverse=True)
        number = np.array(
            [self.symbol.get(chr(c), self.size + c) for c in distinct.tolist()], np.int64
        )
        lengths = np.array([len(w) for w in words], np.int64)
        symbols, word = self.merge(number[where], np.repeat(np.arange(len(words)), lengths))
        rare = np.flatnonzero(symbols >= self.size)
        if len(rare):  # a character that is no piece becomes its bytes
            raw = [chr(c - self.size).encode("utf-8", "surrogatepass") for c in symbols[rare]]
            counts = np.ones(len(symbols), np.int64)
            counts[rare] = [len(r) for r in raw]
            at = np.cumsum(counts) - counts
            word, symbols = np.repeat(word, counts), np.repeat(symbols, counts)
            flat = np.frombuffer(b"".join(raw), np.uint8)
            symbols[ranges(at[rare], counts[rare])] = self.bytes[flat]
        return symbols.astype(np.int32), np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str | None]) -> pa.Array:
        """The ids of every text, as one Arrow array of lists."""
        if len(self.known) > KEPT_WORDS or self.known.chars > KEPT_CHARS:
            self.known = Words()
        known, found, counts = self.known, [], []
        number = known.__getitem__
        for text in texts:
            words = split_words(text) if text else []
            found.extend(map(number, words))
            counts.append(len(words))
        if known.new:
            known.add(*self.encode_words([SPACE + w for w in known.new]))
        at = np.array(found, np.int64)
        values = known.ids[ranges(known.start[at], known.length[at])]
        ends = np.append(0, np.cumsum(known.length[at]))
        offsets = ends[np.append(0, np.cumsum(np.array(counts, np.int64)))]
        return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values))

    def decode(self, column: pa.Array) -> pa.Array:
        """The texts of lists of ids: the pieces' bytes one after the other, without the prefix."""
        column = one_array(column)
        ids = np.asarray(column.flatten(), np.int64)
        counts = np.asarray(column.value_lengths().fill_null(0), np.int64)
        size = self.raw_at[ids + 1] - self.raw_at[ids]
        raw = self.raw[ranges(self.raw_at[ids], size)].tobytes()
        ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))].tolist()
        texts = []
        for start, end in zip(ends, ends[1:]):
            if raw[start : start + 1] == b" ":
                start += 1
            texts.append(raw[start:end].decode("utf-8", "replace"))
        return pa.array(texts, pa.large_string())


class Words(dict):
    """Numbers of words met so far, with their ids in one flat array; a new word is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.chars = 0
        self.ids = np.zeros(0, np.int32)
        self.start = self.length = np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        self.chars += len(word)
        return number

    def add(self, ids: np.ndarray, length: np.ndarray) -> None:
        """Store the ids of the new words."""
        self.start = np.append(self.start, len(self.ids) + np.cumsum(length) - length)
        self.length = np.append(self.length, length)
        self.ids = np.concatenate([self.ids, ids])
        self.new = []


def split_words(text: str) -> list[str]:
    """Cut before every run of U+2581, of which one stands in front; each word without its first."""
    if "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    words, run = [], 1
    for i, part in enumerate(text.replace(" ", SPACE).split(SPACE)):
        run += i > 0
        if part:
            words.append(SPACE * (run - 1) + part)
            run = 0
    if run:
        words.append(SPACE * (run - 1))
    return words


@lru_cache(maxsize=4)
def model(path: str) -> Model:
    return Model(path)


def ship(df: DataFrame, path: str) -> str:
    """Send the model file, of some hundred kilobytes, to every executor; returns its name."""
    shipped(df).sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of every text, as array<int>."""
    name = ship(df, path)

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        pieces = model(SparkFiles.get(name))
        _, offsets = flat_text(column)
        done = [
            pieces.encode(column.slice(a, b - a).to_pylist()).cast(pa.list_(pa.int32()))
            for a, b in slices(offsets)
        ]
        release()
        return pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.int32()))

    return df.withColumn(out, ids(_text(df, text)))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of every list of ids; null has the empty text."""
    name = ship(df, path)

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return model(SparkFiles.get(name)).decode(column).cast(pa.string())

    return df.withColumn(out, text(df[ids]))


def _text(df: DataFrame, text: str) -> Column:
    return F.coalesce(df[text], F.lit(""))

