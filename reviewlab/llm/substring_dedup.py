"""Substring deduplication by sliding sentence spans, in DataFrame operations only.

A text is cut into sentences (after . ! ? and white space, and after line ends), which joined give
the text back. The shortest run of sentences from every sentence on that has ``min_words`` words and
more than one sentence is a span, and so is the shortest that ends with it; a single sentence is one
if it has ``min_single`` words. Together they cover what all such runs cover: a sentence of a longer
run is in the shortest from it on, or that one leaves the longer run and the shortest that ends with
its last sentence holds it. A span depends on its own sentences only, so a passage has the same spans
wherever it stands. The spans'
hashes are joined over all documents; the first place of a span, by key and position, keeps it, and
every sentence covered by another place of a repeated span is removed.

A span that very many documents hold is one key: the first place is an aggregate, reduced before
the shuffle, and the join back is one whose large partitions adaptive execution splits. What is
collected per document is bounded by the document.

Defined results: a null text is an empty one and stays null; sentences are equal if their words are,
in lower case; documents without a key come last; rows repeated in full, and places of
equal key, text and position, are one place and get equal results; an empty table gives an empty
table. All other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.frames import written
from reviewlab.llm.words import bound, folded

# A sentence ends after . ! ? and white space, and after a line end; more space belongs to it.
SENTENCE_END = r"(?<=[.!?]\s)(?!\s)|(?<=\n)(?!\s)"
MIN_WORDS, MIN_SINGLE = 16, 30
RESULTS = ("n_sentences", "n_removed", "kept")


def sentences(text: Column) -> Column:
    """The sentences of a text with all their characters."""
    return F.split(F.coalesce(text, F.lit("")), SENTENCE_END)


def spans(pieces: Column, min_words: int, min_single: int) -> Column:
    """Array of (span hash, first sentence, after the last) of a text's spans."""

    def of(split: Column) -> Column:
        sizes = F.transform(split, lambda w: F.size(w))
        codes = F.transform(split, lambda w: F.xxhash64(w))
        return bound(sizes, lambda n: bound(codes, lambda c: _runs(n, c, min_words, min_single)))

    def words(sentence: Column) -> Column:
        return F.filter(F.split(folded(sentence), r"\s+"), lambda w: w != "")

    return bound(F.transform(pieces, words), of)


def _runs(words: Column, codes: Column, min_words: int, min_single: int) -> Column:
    """The shortest runs; all sentences but the first have a word, so min_words + 1 are enough."""
    most = min_words + 1

    def length(i: Column, step: int, single: int | None) -> Column:
        total = F.get(words, i)
        out = F.when(total >= min_single, single)
        for n in range(2, most + 1):
            total = total + F.get(words, i + step * (n - 1))
            out = out.when(total >= min_words, n)
        return out

    def places(lengths: Column, first) -> Column:
        every = F.transform(
            lengths,
            lambda n, i: F.struct(
                F.xxhash64(F.slice(codes, first(n, i) + 1, F.coalesce(n, F.lit(0))), n).alias("span"),
                first(n, i).alias("first"),
                (first(n, i) + n).alias("after"),
            ),
        )
        return F.filter(every, lambda p: p["after"].isNotNull())

    def both(starts: Column) -> Column:
        # what a run that ends with a single span covers besides is in the runs from its sentences on
        ends = F.transform(codes, lambda c, i: length(i, -1, None))
        other = F.transform(ends, lambda n, i: F.when(~F.get(starts, i - n + 1).eqNullSafe(n), n))
        backward = places(other, lambda n, i: F.coalesce(i - n + 1, F.lit(0)))
        return F.concat(places(starts, lambda n, i: i), backward)

    return bound(F.transform(codes, lambda c, i: length(i, 1, 1)), both)


def dedup(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    min_single: int = MIN_SINGLE,
) -> DataFrame:
    """Add n_sentences, n_removed and kept, the text without the removed sentences."""
    rows = df.select(df[key].alias("key"), df[text].alias("text"))
    code = F.xxhash64("text")
    found = rows.select(
        "key", code.alias("code"), F.explode(spans(sentences(F.col("text")), min_words, min_single)).alias("s")
    )
    found = written(found.select("key", "code", "s.*"), "spans")
    place = F.struct(F.col("key").isNull().alias("last"), "key", "code", "first")
    repeated = (
        found.groupBy("span")
        .agg(F.min(place).alias("least"), F.max(place).alias("most"))
        .filter("least <> most")
        .select("span", F.struct("least.key", "least.code", "least.first").alias("least"))
    )
    # written, so that the join can split a hot span; at every size it is the same join
    repeated = written(repeated, "repeated")
    covered = (
        found.join(repeated, "span")
        .filter(~F.struct("key", "code", "first").eqNullSafe(F.col("least")))
        .groupBy("key", "code")
        .agg(F.collect_set(F.struct("first", "after")).alias("spans"))
        .select(
            F.col("key").alias("_hit_key"),
            F.col("code").alias("_hit_code"),
            F.array_distinct(
                F.flatten(
                    F.transform("spans", lambda s: F.sequence(s["first"], s["after"] - 1))
                )
            ).alias("_removed"),
        )
    )
    pieces = sentences(df[text])

    def left(p: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(p) - 1)
        return F.array_join(F.transform(F.array_except(every, "_removed"), lambda i: F.get(p, i)), "")

    same = df[key].eqNullSafe(F.col("_hit_key")) & (F.xxhash64(df[text]) == F.col("_hit_code"))
    kept = [c for c in df.columns if c not in RESULTS]
    count = F.when(F.length(F.coalesce(df[text], F.lit(""))) > 0, F.size(pieces)).otherwise(0)
    return df.join(covered, same, "left").select(
        *(df[c] for c in kept),
        count.cast("long").alias("n_sentences"),
        F.coalesce(F.size("_removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("_removed").isNull(), df[text]).otherwise(bound(pieces, left)).alias("kept"),
    )
