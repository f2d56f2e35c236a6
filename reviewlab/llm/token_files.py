"""Token ids in binary files: documents compressed one by one with a shared zstandard dictionary.

A folder holds ``dictionary.zdict`` and data files. A data file is

* the head: 8 bytes ``MAGIC``, 32 bytes SHA-256 of the dictionary, the bytes of one id (2 or 4);
* one zstandard frame per document, of its ids as little-endian unsigned integers;
* the index: per document its key, whether it has one, the place of its frame and its number of
  ids (four arrays), then their number and ``MAGIC`` again, so that a reader needs the end of the
  file and one frame to get a document.

The texts are encoded where they are read, and only the compressed frames are shuffled: quantiles
of the key cut the rows into as many parts as there are shuffle partitions, a key that fills
several parts is dealt over them by row number, every part is sorted and written as files of at
most about ``FILE_BYTES``. A task names its files anew each time it runs; the manifest, a table
that Spark commits, lists the files of the task that counted, and nothing else is ever read. The
driver sees the dictionary's sample and one number per part.

Where the tokenizer is byte-level BPE cut by the usual pattern and a text has ASCII and Latin
letters only, numpy cuts a batch into words, each distinct word goes through the library's model once
and is kept (two generations of ``PIECES`` per worker), and the ids are gathered. Any other text goes
through the library whole. Both give the library's ids.

Defined results: a null text is empty; documents are in ascending order of the key, null keys
first, rows with one key in an order fixed by the input's; an empty text has the end id alone; an
empty table has no files. With too few short texts to train on there is no dictionary and its
bytes are empty. Keys are integers. Columns other than the two named ones are not used.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewlab.llm.arrays import flat_text, mix, one_array, ranges, slices
from reviewlab.llm.frames import shipped, written

MAGIC = b"RLIDS001"
HEAD = struct.Struct("<8s32sB")
TAIL = struct.Struct("<Q8s")
FILE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
# Words of a generation, and bytes of text that are cut into words at a time.
PIECES = 500_000
SLICE_BYTES = 2 << 20
LEVEL = 3

# The dictionary is trained on at most this many texts of at most so many characters.
MAX_SAMPLE, MAX_SAMPLE_CHARS = 2_000, 4_096
DICTIONARY_BYTES = 64 << 10

LEAST = -(1 << 63)
# Classes of bytes, as the pre-tokenizer's pattern tells them apart. Bytes from 0xC3 on begin or
# go on with a Latin letter (up to U+02BF; without the signs at 0xC3 0x97 and 0xC3 0xB7).
SPACE, BREAK, LETTER, DIGIT, SIGN, ODD = range(6)
CLASS = np.full(256, ODD, np.uint8)
CLASS[0x21:0x7F] = SIGN
CLASS[[0x09, 0x0A, 0x0D]] = BREAK
CLASS[0x20] = SPACE
CLASS[0x30:0x3A] = DIGIT
CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCB)]] = LETTER
TIMES, DIVISION = 0x97, 0xB7


def byte_letters() -> dict[int, int]:
    """The letter that stands for a byte in a byte-level vocabulary: a visible one for itself, and
    the others one after the other from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(others)}


MANIFEST = (
    "part int, number int, file string, first long, docs long, tokens long, bytes long, "
    "least long, most long"
)
ENCODED = "key long, part int, row long, n long, frame binary"


class Encoder:
    """Serialized ids of texts, and of words that are kept in two generations."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        state = json.loads(self.tokenizer.to_str())
        cut = state["pre_tokenizer"] or {}
        self.by_word = (
            state["model"]["type"] == "BPE"
            and not state["model"].get("dropout")
            and state["normalizer"] is None
            and state["truncation"] is None
            and (cut.get("type"), cut.get("use_regex")) == ("ByteLevel", True)
            and not cut.get("add_prefix_space")
        )
        self.added = [t["content"] for t in state["added_tokens"]]
        self.letters = byte_letters()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.kind).tobytes()

    def _word(self, word: bytes) -> bytes:
        """A word that the young generation doesn't have; full, that becomes the old one."""
        ids = self.old.get(word)
        if ids is None and b"'" in word:  # may be several pieces
            ids = self._whole(word.decode())
        elif ids is None:
            tokens = self.tokenizer.model.tokenize(word.decode("latin-1").translate(self.letters))
            ids = np.array([t.id for t in tokens], self.kind).tobytes()
        if len(self.young) >= PIECES:
            self.old, self.young = self.young, {}
        self.young[word] = ids
        return ids

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text; a null is empty."""
        texts = one_array(texts).cast(pa.large_string()).fill_null("")
        raw, at = flat_text(texts)
        plain = np.full(len(texts), self.by_word)
        odd = np.append(0, np.cumsum(CLASS[raw] == ODD))
        if len(raw) > 1:
            signs = (raw[:-1] == 0xC3) & ((raw[1:] == TIMES) | (raw[1:] == DIVISION))
            odd[1:-1] += np.cumsum(signs)
            odd[-1] += signs.sum()
        plain &= odd[at[1:]] == odd[at[:-1]]
        for token in self.added:
            plain &= ~np.asarray(pc.match_substring(texts, token))
        done: list[bytes] = [b""] * len(texts)
        for i in np.flatnonzero(~plain):
            done[i] = self._whole(texts[int(i)].as_py())
        rows = np.flatnonzero(plain)
        raw, at = flat_text(texts.take(pa.array(rows)))
        for a, b in slices(at, SLICE_BYTES):
            ids, ends = self._by_word(raw[at[a] : at[b]], at[a : b + 1] - at[a])
            for i, first, last in zip(rows[a:b].tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                done[i] = ids[first:last].tobytes()
        return done

    def _by_word(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where the texts' ids end) of flat texts, from the ids of their distinct words."""
        starts = np.append(word_starts(raw, at), len(raw))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(raw)]
        ).dictionary_encode()
        young = self.young.get
        known = [young(w) or self._word(w) for w in words.dictionary.to_pylist()]
        length = np.fromiter(map(len, known), np.int64, len(known)) // self.kind.itemsize
        first = np.cumsum(length) - length
        flat = np.frombuffer(b"".join(known), self.kind)
        of = np.asarray(words.indices)
        ids = flat[ranges(first[of], length[of])]
        total = np.append(0, np.cumsum(length[of]))
        return ids, total[np.searchsorted(starts, at)]


def word_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer's pieces of flat texts begin; words with an apostrophe stay whole.

    A piece is a run of letters, digits or signs with the space before it; white space is cut from
    the last of its run where something follows.
    """
    if not len(raw):
        return np.zeros(0, np.int64)
    kind = CLASS[raw]
    white = kind <= BREAK
    begins = np.zeros(len(raw) + 1, bool)  # a text begins
    begins[at] = True
    before = np.append(LETTER, kind[:-1])
    white_before = np.append(False, white[:-1])
    goes_on = np.append(~white[1:], False) & ~begins[1:]  # no white space follows in the text
    start = np.where(
        white, ~white_before | goes_on, (before != kind) & (before != SPACE)
    )
    word = ~white & (white_before | begins[:-1])
    quoted = np.flatnonzero(raw == ord("'"))
    if len(quoted):
        number = np.cumsum(word)
        whole = np.zeros(int(number[-1]) + 1, bool)
        whole[number[quoted]] = True
        start &= white | word | ~whole[number]
    return np.flatnonzero(start | begins[:-1])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary, or none where the samples are too few to train one."""
    samples = [s for s in samples if s]
    size = min(size, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if size >= 256 else b""
    except zstandard.ZstdError:
        return b""


def _codec(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def parts_of(key: np.ndarray, row: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The part of every key; a key that fills several parts is dealt over these by row."""
    low, high = np.searchsorted(cuts, key, "left"), np.searchsorted(cuts, key, "right")
    share = (mix(row.astype(np.uint64)) >> np.uint64(11)) / float(1 << 53)
    several = low + 1 + (share * (high - low)).astype(np.int64)
    return np.where(high - low > 1, several, high).astype(np.int32)


class Writer:
    """One data file; the index is kept until the end."""

    def __init__(self, folder: str, name: str, dictionary: bytes, width: int):
        fs, path = _open(folder)
        self.name, self.out = name, fs.open_output_stream(f"{path}/{name}")
        self.out.write(HEAD.pack(MAGIC, hashlib.sha256(dictionary).digest(), width))
        self.keys: list[int | None] = []
        self.sizes: list[int] = []
        self.counts: list[int] = []
        self.bytes = HEAD.size

    def add(self, key: int | None, n: int, frame: bytes) -> None:
        self.out.write(frame)
        self.bytes += len(frame)
        self.keys.append(key)
        self.sizes.append(len(frame))
        self.counts.append(n)

    def close(self) -> None:
        known = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        at = (HEAD.size + np.append(0, np.cumsum(self.sizes))).astype("<u8")
        index = [keys, known, at, np.array(self.counts, "<u8")]
        self.out.write(b"".join(a.tobytes() for a in index))
        self.out.write(TAIL.pack(len(keys), MAGIC))
        self.out.close()


class Reader:
    """A data file's index, and its documents one by one."""

    def __init__(self, folder: str, name: str):
        fs, path = _open(folder)
        self.file = fs.open_input_file(f"{path}/{name}")
        size = self.file.size()
        magic, digest, width = HEAD.unpack(self.file.read_at(HEAD.size, 0))
        n, end = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        with fs.open_input_file(f"{path}/dictionary.zdict") as f:
            dictionary = f.read()
        if magic != MAGIC or end != MAGIC or hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{name} is no file of this dictionary")
        length = n * 8 + n + (n + 1) * 8 + n * 8
        index = self.file.read_at(length, size - TAIL.size - length)
        self.keys = np.frombuffer(index, "<i8", n)
        self.known = np.frombuffer(index, np.uint8, n, n * 8).astype(bool)
        self.at = np.frombuffer(index, "<u8", n + 1, n * 9).astype(np.int64)
        self.counts = np.frombuffer(index, "<u8", n, n * 9 + (n + 1) * 8).astype(np.int64)
        self.kind = np.dtype(f"<u{width}")
        self.zstd = zstandard.ZstdDecompressor(**_codec(dictionary))

    def __len__(self) -> int:
        return len(self.keys)

    def ids(self, i: int, data: bytes | None = None) -> np.ndarray:
        """The ids of document ``i`` of the file."""
        first, last = int(self.at[i]), int(self.at[i + 1])
        frame = self.file.read_at(last - first, first) if data is None else data
        ids = np.frombuffer(self.zstd.decompress(frame), self.kind)
        if len(ids) != self.counts[i]:
            raise ValueError(f"document {i} has {len(ids)} ids, its index says {self.counts[i]}")
        return ids

    def find(self, key: int) -> list[np.ndarray]:
        """The ids of the documents with a key; reads their frames only."""
        nulls = len(self.keys) - int(self.known.sum())
        first, last = (nulls + np.searchsorted(self.keys[nulls:], key, s) for s in ("left", "right"))
        return [self.ids(i) for i in range(first, last)]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order; the file is read in blocks of ``BATCH_BYTES`` or one frame."""
        first = 0
        while first < len(self):
            last = int(np.searchsorted(self.at, self.at[first] + BATCH_BYTES, "right")) - 1
            last = min(max(last, first + 1), len(self))
            block = self.file.read_at(int(self.at[last] - self.at[first]), int(self.at[first]))
            for i in range(first, last):
                a, b = self.at[i] - self.at[first], self.at[i + 1] - self.at[first]
                yield int(self.keys[i]) if self.known[i] else None, self.ids(i, block[a:b])
            first = last


def dictionary_of(rows: DataFrame, path: str, end: int, limit: int = MAX_SAMPLE) -> bytes:
    """A dictionary trained on at most ``limit`` short texts, those whose keys' hashes are smallest.

    Only hashes small enough for about so many rows are looked at, so tasks send few texts.
    """
    share = int(min(1.0, 2 * limit / max(1, rows.select("key").count())) * (1 << 30))
    short = rows.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share).filter(
        F.char_length("text").between(1, MAX_SAMPLE_CHARS)
    )
    sample = short.orderBy(F.xxhash64("key", "text"), "key", "text").limit(limit).select("text")
    codes, tail = encoder(path), np.array([end], encoder(path).kind).tobytes()
    texts = pa.array([r.text for r in sample.collect()], pa.string())
    return train([ids + tail for ids in codes.encode(texts)])


def write(
    df: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = 0
) -> DataFrame:
    """Write the ids of every text, each ended by ``end``, to a new folder; returns the manifest.

    ``tokenizer`` is a tokenizers file that the executors have under the same path. The manifest
    has one row per file: its part, number in the part, name, ids before it in the part, documents,
    ids and bytes, and the first and last key.
    """
    spark = df.sparkSession
    rows = shipped(df).select(df[key].cast("long").alias("key"), df[text].alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    place = F.coalesce("key", F.lit(LEAST))
    found = rows.agg(F.percentile_approx(place, shares, 20 * parts).alias("cuts")).first().cuts
    cuts = np.array(found or [], np.int64) if parts > 1 else np.array([], np.int64)
    dictionary = dictionary_of(rows, tokenizer, end)
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/dictionary.zdict") as f:
        f.write(dictionary)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer)
        zstd = zstandard.ZstdCompressor(level=LEVEL, **_codec(dictionary))
        tail = np.array([end], codes.kind).tobytes()
        for batch in batches:
            place = np.asarray(one_array(batch["key"]).fill_null(LEAST))
            part = parts_of(place, np.asarray(batch["row"]), cuts)
            size, frames = [], []
            for ids in codes.encode(batch["text"]):
                ids += tail
                size.append(len(ids) // codes.kind.itemsize)
                frames.append(zstd.compress(ids))
            columns = [batch["key"], pa.array(part), batch["row"], pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(frames, pa.binary())], ["key", "part", "row", "n", "frame"]
            )

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, done = encoder(tokenizer).kind.itemsize, []
        now, file, number, first, tokens = None, None, 0, 0, 0

        def closed() -> None:
            if file is not None:
                file.close()
                keys = [k for k in (file.keys[0], file.keys[-1]) if k is not None]
                least, most = (min(keys), max(keys)) if keys else (None, None)
                counts = (first, len(file.keys), tokens - first, file.bytes)
                done.append((now, number, file.name, *counts, least, most))

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("key", "part", "n", "frame"))
            for document, part, n, frame in zip(*columns):
                if part != now or file.bytes >= FILE_BYTES:
                    closed()
                    number = number + 1 if part == now else 0
                    first = tokens = tokens if part == now else 0
                    now = part
                    file = Writer(folder, f"{part:06}-{number:04}-{uuid.uuid4().hex}.ids", dictionary, width)
                file.add(document, n, frame)
                tokens += n
        closed()
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 6]
        arrays = [pa.array([x[i] for x in done], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names)

    rows = rows.withColumn("row", F.monotonically_increasing_id())
    sorted_rows = (
        rows.mapInArrow(encoded, ENCODED)
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions(F.asc("part"), F.asc_nulls_first("key"), F.asc("row"))
    )
    manifest = sorted_rows.mapInArrow(files, MANIFEST).withColumn("folder", F.lit(folder))
    return written(manifest, "token-manifest")


def starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids in all files before each.

    One number per part, of which there are as many as shuffle partitions, goes by the driver.
    """
    sums = sorted(manifest.groupBy("part").agg(F.sum("tokens").alias("n")).collect())
    before = np.append(0, np.cumsum([r.n for r in sums]))[:-1].tolist()
    offsets = [(r.part, b) for r, b in zip(sums, before)]
    table = manifest.sparkSession.createDataFrame(offsets, "part int, before long")
    joined = manifest.join(F.broadcast(table), "part")
    return joined.withColumn("start", F.col("before") + F.col("first")).drop("before")


def read(manifest: DataFrame) -> DataFrame:
    """(key, start, n_tokens, ids) of all documents, from the files of a manifest.

    ``start`` are the ids of all documents before; ``ids`` are little-endian unsigned 32-bit.
    """
    spark = manifest.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "start", "n_tokens", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for folder, name, start in zip(*(batch[c].to_pylist() for c in ("folder", "file", "start"))):
                rows, size = [], 0
                for key, ids in Reader(folder, name).documents():
                    rows.append((key, start, len(ids), ids.astype("<u4").tobytes()))
                    start += len(ids)
                    size += len(rows[-1][3])
                    if size >= BATCH_BYTES:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    files = starts(shipped(manifest)).repartitionById(parts, F.col("part"))
    files = files.select("folder", "file", "start")
    return files.mapInArrow(documents, "key long, start long, n_tokens long, ids binary")


def lookup(manifest: DataFrame, key: int) -> list[np.ndarray]:
    """The ids of the documents with one key: the few files that may hold it are opened here."""
    files = manifest.filter(F.lit(key).between(F.col("least"), F.col("most")))
    found = files.select("folder", "file").orderBy("part", "number").toLocalIterator()
    return [ids for r in found for ids in Reader(r.folder, r.file).find(key)]
