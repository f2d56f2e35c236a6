"""Benchmark decontamination by winnowing, in DataFrame operations only.

Of every run of consecutive words that is as long as a benchmark window, the least hash of its
word k-grams is a fingerprint; a fingerprint that follows from several runs in a row is kept once,
with the places of these runs. Texts that share a window share its fingerprint, whatever stands
around it. Documents meet benchmark windows in a join on fingerprints, and every hit is extended:
the words at the places of the fingerprint are compared with the words of the window.

Items of fewer words than a window are windows of their own length; every such length present (at
most nine) has its own fingerprints.

Defined results: a null or empty text has no words and no hits; benchmark rows without an id or
without words have no windows; rows that share an item id are one item; rows that share a document
id keep their own text's result, and repeated rows give repeated rows. Empty tables give no hits.
Texts of any length are processed whole, in time proportional to their length. Other columns are
not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.frames import small, written
from reviewlab.llm.words import ascii_lower, bound, folded, sliding, split_words

WINDOW = 10
FOUND = "array<struct<length:int,fingerprint:bigint,first:int,last:int>>"


def gram_length(window: int) -> int:
    """The largest power of two up to half a window."""
    k = 1
    while 4 * k <= window:
        k *= 2
    return k


def fingerprints(hashes: Column, window: int) -> Column:
    """Array of (window length, fingerprint, first, last) of the runs first..last, from 1.

    ``hashes`` are a text's word hashes, bound before. A fingerprint is the least hash of the
    k-grams in a run of ``window`` words.
    """
    k = gram_length(window)
    runs = F.size(hashes) - F.lit(window) + 1

    def kept(minima: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), runs - 1),
            lambda i: (i == 0) | (F.get(minima, i) != F.get(minima, i - 1)),
        )

        def spans(s: Column) -> Column:
            return F.transform(
                s,
                lambda i, n: F.struct(
                    F.lit(window).alias("length"),
                    F.get(minima, i).alias("fingerprint"),
                    (i + 1).alias("first"),
                    F.coalesce(F.get(s, n + 1), runs).alias("last"),
                ),
            )

        return bound(starts, spans)

    def least(grams: Column) -> Column:
        return sliding(grams, window - k + 1, F.least, kept)

    return F.when(runs >= 1, sliding(hashes, k, F.xxhash64, least)).otherwise(F.array().cast(FOUND))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def found_in(words: Column, lengths: list[int]) -> Column:
    """The fingerprints of a text for every window length; first the number of its words."""

    def all_lengths(hashes: Column) -> Column:
        size = F.array(
            F.struct(
                F.lit(0).alias("length"),
                F.lit(None).cast("bigint").alias("fingerprint"),
                F.lit(0).alias("first"),
                F.size(hashes).alias("last"),
            )
        )
        return F.concat(size, *(fingerprints(hashes, n) for n in lengths))

    return bound(word_hashes(words), all_lengths)


def windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item_id, length, window) of the distinct windows of all items, as joined words."""
    rows = benchmark.select(
        benchmark[item].cast("string").alias("item_id"),
        split_words(ascii_lower(benchmark[text])).alias("words"),
    ).filter("item_id is not null and size(words) > 0")
    taken = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - taken + 1)
    texts = F.transform(starts, lambda i: F.array_join(F.slice("words", i, taken), " "))
    return rows.select("item_id", taken.alias("length"), F.explode(texts).alias("window")).distinct()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(key, n_words, n_hit, items) of every document row; items are sorted id texts."""
    cut = written(windows(benchmark, item, item_text, window), "windows")
    lengths = sorted(r.length for r in cut.select("length").distinct().collect())  # at most window
    own = F.filter(
        found_in(F.split(folded(F.col("window")), " "), lengths),
        lambda f: f["length"] == F.col("length"),
    )
    wanted = cut.select("window", "length").distinct()
    wanted = wanted.select("window", "length", F.get(own, 0)["fingerprint"].alias("fingerprint"))
    wanted = written(wanted, "fingerprints")
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    rows = rows.withColumn("code", F.xxhash64("text"))
    words = split_words(folded(F.coalesce("text", F.lit(""))))
    met = (
        rows.select("key", "code", F.explode(found_in(words, lengths)).alias("f"))
        .select("key", "code", "f.*")
        .join(small(wanted), ["length", "fingerprint"], "left")
        .filter("length = 0 or window is not null")
        .groupBy("key", "code")
        .agg(
            F.max(F.when(F.col("length") == 0, F.col("last"))).cast("long").alias("n_words"),
            F.count(F.when(F.col("length") == 0, 1)).alias("copies"),
            F.collect_list(
                F.when(F.col("length") > 0, F.struct("first", "last", "length", "window"))
            ).alias("hits"),
        )
    )
    met = written(met, "met")
    # extend: compare the words at the places of a hit with the window's
    same = "l.key <=> r.key and l.code = r.code"
    hits = met.filter(F.size("hits") > 0).select("key", "code", "hits")
    touched = hits.alias("l").join(rows.alias("r"), F.expr(same)).select("l.*", "r.text")

    def places(w: Column) -> Column:
        def of_hit(h: Column) -> Column:
            starts = F.filter(
                F.sequence(h["first"], h["last"]),
                lambda i: F.array_join(F.slice(w, i, h["length"]), " ") == h["window"],
            )
            return F.transform(
                starts,
                lambda i: F.struct(
                    i.alias("first"), (i + h["length"]).alias("after"), h["window"].alias("window")
                ),
            )

        return F.flatten(F.transform("hits", of_hit))

    checked = touched.select(
        "key", "code", bound(split_words(ascii_lower(F.col("text"))), places).alias("places")
    )
    checked = checked.filter(F.size("places") > 0).dropDuplicates(["key", "code"])
    checked = written(checked, "places")
    covered = F.aggregate(
        F.array_sort("places"),
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("words")),
        lambda a, p: F.struct(
            F.greatest(a["upto"], p["after"]).alias("upto"),
            (
                a["words"]
                + F.greatest(p["after"] - F.greatest(p["first"], a["upto"]), F.lit(0))
            ).alias("words"),
        ),
    )["words"]
    ids = (
        checked.select(
            "key", "code", F.explode(F.array_distinct(F.col("places.window"))).alias("window")
        )
        .join(small(cut.select("window", "item_id").distinct()), "window")
        .select("key", "code", "item_id")
        .distinct()
        .groupBy("key", "code")
        .agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    hit = (
        checked.select("key", "code", covered.alias("n_hit"))
        .alias("l")
        .join(ids.alias("r"), F.expr(same))
        .select("l.key", "l.code", "n_hit", "items")
    )
    return (
        met.select("key", "code", "n_words", "copies")
        .alias("l")
        .join(hit.alias("r"), F.expr(same), "left")
        .select(
            F.col("l.key").alias(key),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        )
        .drop("copy")
    )
