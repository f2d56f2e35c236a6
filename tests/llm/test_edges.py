"""Every operator and stage on odd rows, with clashing columns, and on empty tables."""

from __future__ import annotations

import corpus_pipeline
import pytest

from reviewlab.llm import (
    chat,
    decontaminate,
    fingerprints,
    jaccard_join,
    licenses,
    pii,
    quality,
    secrets,
    sentencepiece_bpe,
    substring_dedup,
)
from reviewlab.llm.queries import MODEL

BENCH = "item_id bigint, text string"


def bench(spark):
    words = " ".join(f"word{i}" for i in range(5, 30))
    rows = [(1, words), (2, None), (None, "lost item"), (3, ""), (4, "one"), (5, "one"), (5, "Two three!")]
    return spark.createDataFrame(rows, BENCH)


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def test_decontaminate(spark, clashing, none):
    got = by_id(decontaminate.decontaminate(clashing, bench(spark)), "n_words", "n_hit", "items")
    assert got[1] == got[2] == got[3] == (0, 0, [])
    assert got[5] == got[6] == got[None] == (60, 25, ["1"])
    assert got[7] == (61, 25, ["1"])
    assert got[8] == (1, 1, ["4", "5"])
    assert got[4][1] == 0
    assert decontaminate.decontaminate(clashing, bench(spark)).count() == clashing.count()
    assert decontaminate.decontaminate(none, bench(spark)).count() == 0
    empty = spark.createDataFrame([], BENCH)
    assert decontaminate.decontaminate(clashing, empty).filter("n_hit > 0").count() == 0


def test_pii(clashing, none):
    field = pii.fit(clashing)
    got = by_id(pii.scan(clashing, field), "pii")
    assert got[1] == got[2] == ([],)
    kinds = [s["kind"] for s in got[9][0]]
    assert kinds.count("email") == 1 and "phone" in kinds
    assert pii.scan(none, pii.fit(none)).count() == 0
    assert pii.scan(clashing, pii.base_field()).columns == [*clashing.columns, "pii"]


def test_jaccard_join(clashing, none):
    got = by_id(jaccard_join.groups(clashing), "n_shingles", "component_id")
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[3] == (0, 3)
    assert got[5] == got[6] == (57, 5) and got[7] == (58, 5)
    assert got[8] == (1, 8)
    assert got[None] == (57, None)
    assert jaccard_join.groups(none).count() == 0


def test_licenses(spark, clashing, none):
    templates = licenses.default_templates(spark)
    assert licenses.scan(clashing, templates).count() == 0
    assert licenses.scan(none, templates).count() == 0
    rows = [(1, "x\nReleased under the  MIT license"), (2, "released under the Tea License.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [tuple(r) for r in licenses.scan(docs, templates).collect()]
    assert found == [(1, 1, "MIT", 1.0)]


def test_chat(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted string"
    rows = [
        (1, 0, "user", None, "x"),
        (1, 1, "assistant", "a\\#<b </turn>\n### user: ", "x"),
        (1, 1, "assistant", "a\\#<b </turn>\n### user: ", "x"),
        (None, None, None, "", "x"),
        (None, 2, "ro:le\\", "é\U0001f600", "x"),
        (2, 0, "assistant", " ", "x"),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3] or "") for r in rows[:3]]
    assert got[1].learnt == rows[1][3] * 2
    assert [(t.role, t.text) for t in got[None].turns] == [("", ""), ("ro:le\\", "é\U0001f600")]
    assert got[2].learnt == " " and got[None].learnt == ""
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_substring_dedup(clashing, none):
    got = by_id(substring_dedup.dedup(clashing), "n_sentences", "n_removed", "kept")
    assert got[1] == (0, 0, None) and got[2] == (0, 0, "")
    assert got[5][1] == 0 and got[6] == (1, 1, "") and got[None] == (1, 1, "")
    assert got[7][1] == 0
    assert substring_dedup.dedup(none).count() == 0
    assert substring_dedup.dedup(clashing).count() == clashing.count()


def test_sentencepiece(clashing, none):
    done = sentencepiece_bpe.decode(sentencepiece_bpe.encode(clashing, MODEL), MODEL)
    for r in done.collect():
        assert r.decoded == (r.text or "")
    assert by_id(done, "ids")[1] == ([],)
    assert sentencepiece_bpe.encode(none, MODEL).count() == 0


def test_quality(spark, clashing, none):
    labels = "doc_id bigint, quality int, toxic int"
    marks = spark.createDataFrame([(1, None, 0), (4, 1, 0), (6, 0, 0), (6, 1, 0), (None, 1, 0)], labels)
    trees = quality.fit(clashing, marks)
    got = by_id(quality.score(clashing, trees), "score")
    assert all(0 <= s <= 1 for (s,) in got.values()) and got[1] == got[2]
    assert quality.score(none, trees).count() == 0
    unlabelled = quality.fit(none, spark.createDataFrame([], labels))
    assert {r.score for r in quality.score(clashing, unlabelled).collect()} == {0.5}


def test_secrets(clashing, none):
    found = secrets.scan(clashing)
    got = by_id(found, "secrets")
    assert got[1] == got[2] == ([],)
    assert [s["kind"] for s in got[10][0]] == ["assign", "guess"]
    clean = by_id(secrets.redact(found, "text", "secrets"), "text")
    assert clean[10] == ('[SECRET]" pwd: [SECRET]',) and clean[1] == (None,)
    assert secrets.scan(none).count() == 0


def test_fingerprints(spark, clashing, none):
    from pyspark.sql import functions as F

    texts = clashing.withColumn("other", F.concat(F.coalesce("text", F.lit("")), F.lit(" more words")))
    lexicon = fingerprints.lexicon(texts, "text", 0.0, 1.0)
    names = {"text": "a", "other": "b"}
    table = fingerprints.with_fingerprints(texts, names, lexicon)
    joined = fingerprints.with_fingerprints(texts, names, lexicon, max_lexicon=0)
    assert by_id(table, "a", "b") == by_id(joined, "a", "b")
    got = by_id(table, "a")
    assert got[1] == got[2] and got[5] == got[6] == got[None] != got[4]
    near = by_id(table.withColumn("near", fingerprints.likeness(F.col("a"), F.col("b"))), "near")
    assert near[5][0] > 0.8
    assert fingerprints.with_fingerprints(none, {"text": "a"}, lexicon).count() == 0
    assert fingerprints.with_fingerprints(none, {"text": "a"}, lexicon.limit(0)).count() == 0


@pytest.mark.parametrize("which", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, clashing, none, which):
    from conftest import SF_DIR

    stage = corpus_pipeline.STAGES[which][1]
    last = which == len(corpus_pipeline.STAGES) - 1
    for docs in (clashing, none):
        done = stage(spark, docs, SF_DIR)
        assert done.count() <= docs.count()
        if not last:
            assert done.columns == corpus_pipeline.COLUMNS
    if which == 1:
        left = sorted((r.doc_id is None, r.doc_id or 0) for r in stage(spark, clashing, SF_DIR).collect())
        assert [i for n, i in left if not n] == [1, 2, 3, 4, 5, 8, 9, 10]
