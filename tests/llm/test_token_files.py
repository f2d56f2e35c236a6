"""Token files against the tokenizers library, their index, dictionary and odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewlab.llm import token_files
from reviewlab.llm.queries import TOKENIZER, op12_token_files
from reviewlab.session import scratch_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def stored(spark, df, **conf):
    files = token_files.write(df, scratch_path(spark, "token-files"), TOKENIZER, **conf)
    rows = token_files.read(files).collect()
    return files, [(r.key, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows]


def in_order(rows):
    rows = sorted(rows, key=lambda r: r[1])
    start = 0
    for _, first, ids in rows:
        assert first == start
        start += len(ids)
    keys = [r[0] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    return rows


def test_query(spark, library):
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in op12_token_files(spark, SF_DIR).collect()}
    assert len(got) == len(texts)
    start = 0
    for r in texts:
        ids = np.array(ids_of(library, r.text), "<u4")
        row = got[r.doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_odd_rows(spark, library, clashing, none, odd_rows):
    _, rows = stored(spark, clashing.repartition(3))
    rows = in_order(rows)
    wanted = sorted(((r[0] is not None, r[0] or 0), ids_of(library, r[1])) for r in odd_rows)
    assert sorted(((k is not None, k or 0), ids) for k, _, ids in rows) == wanted
    assert stored(spark, none)[1] == []


def test_one_key_fills_several_parts(spark, library):
    rows = [(3, f"text {i}") for i in range(500)] + [(None, "x")] * 200 + [(i, "y") for i in range(9)]
    files, got = stored(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert len(in_order(got)) == len(rows)
    assert files.agg(F.max("docs")).first()[0] < 300 and files.agg(F.sum("docs")).first()[0] == len(rows)
    assert len(token_files.lookup(files, 3)) == 501 and token_files.lookup(files, 77) == []


def test_short_document_access(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    files, _ = stored(spark, docs)
    row = files.orderBy("part").first()
    reader = token_files.Reader(row.folder, row.file)
    key = int(reader.keys[5])
    text = docs.filter(F.col("doc_id") == key).first().text
    assert [x.tolist() for x in reader.find(key)] == [ids_of(library, text)]
    assert [x.tolist() for x in token_files.lookup(files, key)] == [ids_of(library, text)]
    with open(f"{row.folder.removeprefix('file:')}/dictionary.zdict", "ab") as f:
        assert f.tell() > 0
        f.write(b"x")
    with pytest.raises(ValueError):
        token_files.Reader(row.folder, row.file)


def test_words_and_whole_texts_agree(library):
    codes = token_files.encoder(TOKENIZER)
    around = ("%s", "a%sb", " %s", "a %s %s", "1%s.", "%s\n x", "  %s", "'%s", "é%sß", "it'%s  \t%s ")
    around += ("\n%s's", ".'%s '%s", "%s\n\n \n%s\r ", "a-%s_%s--9", "don't%s'll I'VE %s''s")
    some = [*range(0x520), 0x200B, 0x2028, 0x3000, 0x4E00, 0x1F600]
    texts = [form.replace("%s", chr(c)) for c in some for form in around]
    texts += ["", None, "a<|endoftext|>b", "x y"]
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = codes.encode(pa.array(texts, pa.string()))
    assert [np.frombuffer(x, codes.kind).tolist() for x in got] == wanted


@given(st.lists(st.text(st.sampled_from("ab1 \n\t.,'stréĆ×\u00a0<|"), max_size=30), max_size=8))
@settings(max_examples=300, deadline=None)
def test_any_texts_agree(library, texts):
    codes = token_files.encoder(TOKENIZER)
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = codes.encode(pa.array(texts, pa.string()))
    assert [np.frombuffer(x, codes.kind).tolist() for x in got] == wanted


def test_words_are_kept_in_two_generations(library, monkeypatch):
    monkeypatch.setattr(token_files, "PIECES", 3)
    codes = token_files.Encoder(TOKENIZER)
    text = " ".join(f"w{i % 5} x{i % 3}" for i in range(40))
    got = codes.encode(pa.array([text, text]))
    ids = library.encode(text, add_special_tokens=False).ids
    assert [np.frombuffer(x, codes.kind).tolist() for x in got] == [ids, ids]
    assert len(codes.young) <= 3 and len(codes.old) <= 3
