"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import random
import re
import textwrap

import corpus_pipeline
import pyarrow as pa
import pytest

from reviewlab.llm import jaccard_join, licenses, secrets, substring_dedup


@pytest.mark.parametrize(
    "text, clean",
    [
        ("a password=Summer2024Paris!x#99 b", "a [SECRET] b"),
        ("a pwd: x0123456789abcdef#Zk9! b", "a pwd: [SECRET] b"),
        ("a token=abcdefghijkl b", "a [SECRET] b"),
    ],
)
def test_value_masked_whole(text, clean):
    found = secrets.spans(text, secrets.Guesser())
    assert secrets.masked(text, [(s, e) for s, _, e, _ in found], "[SECRET]") == clean


def _words(start, n):
    return [f"w{i}" for i in range(start, start + n)]


def test_key_with_two_texts(spark):
    """A node's sketch is that of its own text, and both texts of a key keep their links."""
    one, two = _words(0, 60), _words(1000, 60)
    t1, t2 = " ".join(one), " ".join(two)
    node = {}
    for t in (t1, t2):
        grams = jaccard_join.ngram_sets(pa.array([t]), 4)
        node[t] = jaccard_join.node_of(next(iter(grams)))
    rows = [(node[t1], t2), (node[t1], t1), (node[t2], t1), (node[t2], t2)]
    got = jaccard_join.wide_sketches(spark.createDataFrame(rows, "node bigint, text string").coalesce(1), 4)
    for r in got.collect():
        own = next(t for t in node if node[t] == r.node)
        grams = next(iter(jaccard_join.ngram_sets(pa.array([own]), 4)))
        assert r.wide == jaccard_join.sketch_of(grams, jaccard_join.WIDE_BITS).tolist()
    rows = [(5, t2), (5, t1), (6, t1 + " more"), (7, t2 + " more")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id bigint, text string").coalesce(1)
        found = jaccard_join.groups(df, n=4, percent=85).collect()
        assert {(r.doc_id, r.component_id) for r in found} == {(5, 5), (6, 5), (7, 5)}


def _all_runs(text):
    """Every run of sentences that counts as repeated if it is elsewhere, also the long ones."""
    pieces = re.split(r"(?<=[.!?]\s)(?!\s)|(?<=\n)(?!\s)", text)
    words = [tuple(p.lower().split()) for p in pieces]
    for i in range(len(pieces)):
        for j in range(i + 1, len(pieces) + 1):
            total = sum(map(len, words[i:j]))
            if total >= (substring_dedup.MIN_SINGLE if j == i + 1 else substring_dedup.MIN_WORDS):
                yield tuple(words[i:j]), i, j


def test_repeated_passage_goes_to_its_end(spark):
    rng = random.Random(3)

    def sentence(n):
        return " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(n)) + ". "

    passages = [[sentence(n) for n in sizes] for sizes in ((20, 5, 10), (6, 6, 6), (31, 4), (40, 20), (3, 35, 2), (5, 31))]
    for _ in range(30):
        passages.append([sentence(rng.choice((1, 2, 4, 7, 12, 17, 33))) for _ in range(rng.randint(2, 7))])
    docs = []
    for p in passages:
        docs += [sentence(5) + "".join(p) + sentence(9), sentence(3) + "".join(p) + sentence(2)]
    first, gone = {}, [set() for _ in docs]
    for doc, text in enumerate(docs):
        for run, i, j in _all_runs(text):
            if first.setdefault(run, (doc, i)) != (doc, i):
                gone[doc] |= set(range(i, j))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.dedup(df).collect()}
    assert gone[1] == {1, 2, 3}
    assert got == {doc: len(x) for doc, x in enumerate(gone)}


def test_wrapped_and_embedded_licences(spark):
    def wrapped(name, lead, width):
        text = textwrap.fill(licenses.TEXTS[name], width, initial_indent=lead, subsequent_indent=lead)
        return "Some tool\n\n" + text + "\n\nimport os\n"

    notice = "The parser was written in spring. Released under the MIT License. It reads tables of any size, and more."
    rows = [
        (1, wrapped("Apache-2.0 header", "# ", 80)),
        (2, wrapped("MIT text", "", 72)),
        (3, "A line\n" + notice),
        (4, "Released under\nthe MIT License.\nText\nReleased under the MIT License.\nx " + notice),
        (5, "The licence of the software is free, the terms of the software are open."),
        (None, wrapped("BSD-3-Clause text", " * ", 60)),
        (6, notice),
        (6, notice),
        (7, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = licenses.scan(docs, licenses.default_templates(spark)).collect()
    got = sorted(((r.doc_id or 0, r.line, r.template) for r in found), key=str)
    assert (1, 2, "Apache-2.0 header") in got and (2, 2, "MIT text") in got and (0, 2, "BSD-3-Clause text") in got
    assert [x for x in got if x[0] == 3] == [(3, 1, "MIT")]
    assert [x for x in got if x[0] == 4] == [(4, 0, "MIT"), (4, 3, "MIT"), (4, 4, "MIT")]
    assert [x for x in got if x[0] == 6] == [(6, 0, "MIT")] * 2
    assert not [x for x in got if x[0] in (5, 7)]


def test_ordinary_words_are_no_secrets(spark):
    prose = "We always listen to nothing while the building and its infrastructure are under construction today."
    plain = ["The secret: always listen", "pwd: building", "token: nothing", "passcode: infrastructure."]
    leaked = ["passphrase: vqzkxwjbyr"] * 6  # a copied secret is no word
    rows = list(enumerate([prose] * 5 + plain + leaked))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: len(r.secrets) for r in secrets.scan(df).collect()}
    assert got == {i: int(t in leaked) for i, t in rows}
    assert secrets.dictionary(df, most=0) == []
    assert len(secrets.dictionary(df)) >= 10


def test_stages_decide_by_row(spark, tmp_path):
    """Null and repeated ids: every text is judged by itself, and one of a group stays."""
    one, two, three = (" ".join(_words(i, 60)) for i in (0, 1000, 2000))
    rows = [(None, one), (None, two), (1, one), (1, two), (2, three), (2, three), (3, ""), (4, None), (None, three)]
    rows = [(i, t, "en", "a", len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    def left(stage):
        return sorted(((r.doc_id, r.text) for r in stage(spark, docs, str(tmp_path)).collect()), key=str)

    want = [(1, one), (1, two), (2, three), (3, ""), (4, None)]
    assert left(corpus_pipeline.near_duplicates) == sorted(want, key=str)
    bench = spark.createDataFrame([(1, " ".join(_words(10, 20)))], "item_id bigint, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    want = [r[:2] for r in rows if r[1] != one]
    assert left(corpus_pipeline.remove_contaminated) == sorted(want, key=str)
