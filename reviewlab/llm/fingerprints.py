"""I-Match document fingerprints over randomised lexicons, in DataFrame operations only.

The lexicon holds the terms whose document frequency lies in a band: at least ``min_share`` and at
most ``max_share`` of all documents. Every term's md5 deals it to one of SUBSETS random subsets and
gives it a number for thinning. A document keeps its distinct terms in the lexicon; of those in a
subset that the thinning leaves, sorted, the joined text is hashed. Thinning level L leaves one term
in 2^L; a document uses the level at which about one term per subset is left, and the next, so that
a few changed terms change few of its hashes, whatever its length. A fingerprint is the level and
the hashes of both levels; likeness is the share of equal hashes among the subsets that hold terms
of either, at a level that both have.

The lexicon has at most (mean distinct terms of a document) / ``min_share`` terms, whatever the
number of documents. Up to MAX_LEXICON terms it is one small lookup table that every task holds;
a larger one is joined.

Defined results: a null text is an empty one. A text that keeps fewer than LEAST_TERMS terms has
the hash of its text as fingerprint, which is like equal ones only. Equal texts have equal
fingerprints, repeated rows give repeated rows, an empty table gives an empty table. Other columns
are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.frames import written
from reviewlab.llm.words import bound, folded, split_words

MIN_SHARE, MAX_SHARE = 0.002, 0.1
SUBSETS, DIGITS = 32, 4
LEAST_TERMS = 4
LEVELS = 16
MAX_LEXICON = 200_000
BUCKETS = 1 << 14
NO_TERM = "-" * DIGITS
ENTRY = "array<struct<term:string,subset:int,number:int>>"


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(split_words(folded(F.coalesce(text, F.lit("")))))


def lexicon(
    texts: DataFrame, text: str, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE
) -> DataFrame:
    """(term, subset, number) of the terms in the band, over all documents."""
    documents = texts.count()
    code = F.md5("term")
    return (
        texts.select(F.explode(terms(F.col(text))).alias("term"))
        .groupBy("term")
        .count()
        .filter(
            (F.col("count") >= min_share * documents) & (F.col("count") <= max_share * documents)
        )
        .select(
            "term",
            (F.conv(F.substring(code, 1, 2), 16, 10).cast("int") % SUBSETS).alias("subset"),
            F.conv(F.substring(code, 3, 4), 16, 10).cast("int").alias("number"),
        )
    )


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def lookup_table(lexicon: DataFrame) -> Column:
    """The lexicon as one value: an array of buckets of entries."""
    entries = lexicon.groupBy(_bucket(F.col("term")).alias("bucket")).agg(
        F.collect_list(F.struct("term", "subset", "number")).alias("entries")
    )
    every = lexicon.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    rows = every.join(F.broadcast(entries), "bucket", "left").select(
        F.struct("bucket", F.coalesce("entries", F.array().cast(ENTRY)).alias("entries")).alias("b")
    )
    whole = rows.agg(F.array_sort(F.collect_list("b")).alias("b"))
    return whole.select(F.col("b.entries")).scalar()


def kept_by_table(text: Column, table: Column) -> Column:
    """Entries of a text's terms that are in the lexicon."""
    return F.flatten(
        F.transform(
            terms(text),
            lambda term: F.filter(F.get(table, _bucket(term)), lambda e: e["term"] == term),
        )
    )


def kept_by_join(df: DataFrame, columns: dict[str, str], lexicon: DataFrame) -> DataFrame:
    """Add the entries of several text columns by joins; for lexicons of any size."""
    df = df.withColumn("row", F.monotonically_increasing_id())
    df = written(df, "rows")
    for text, out in columns.items():
        found = (
            df.select("row", F.explode(terms(F.col(text))).alias("term"))
            .join(lexicon, "term")
            .groupBy("row")
            .agg(F.collect_list(F.struct("term", "subset", "number")).alias(out))
        )
        df = df.join(found, "row", "left").withColumn(
            out, F.coalesce(out, F.array().cast(ENTRY))
        )
    return df.drop("row")


def fingerprint(entries: Column, text: Column) -> Column:
    """The fingerprint of a text, from the entries it keeps."""

    def hashes(own: Column, level: Column) -> Column:
        step = F.element_at(F.array(*(F.lit(1 << i) for i in range(LEVELS + 1))), level + 1)
        left = F.filter(own, lambda e: e["number"] % step == 0)

        def of_subset(all_left: Column, r: int) -> Column:
            mine = F.transform(F.filter(all_left, lambda e: e["subset"] == r), lambda e: e["term"])
            return bound(
                mine,
                lambda m: F.when(F.size(m) == 0, F.lit(NO_TERM)).otherwise(
                    F.substring(F.md5(F.array_join(F.array_sort(m), " ")), 1, DIGITS)
                ),
            )

        return bound(left, lambda x: F.concat(*(of_subset(x, r) for r in range(SUBSETS))))

    def whole(own: Column) -> Column:
        steps = F.array(*(F.lit(SUBSETS << i) for i in range(LEVELS - 1)))
        level = F.size(F.filter(steps, lambda most: F.size(own) > most))
        return bound(
            level,
            lambda j: F.concat(
                F.lpad(j.cast("string"), 2, "0"), F.lit(":"), hashes(own, j), hashes(own, j + 1)
            ),
        )

    few = F.concat(F.lit("text:"), F.sha2(F.coalesce(text, F.lit("")), 256))
    return bound(entries, lambda own: F.when(F.size(own) < LEAST_TERMS, few).otherwise(whole(own)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes, 0 to 1; 1 for equal fingerprints."""
    level_a, level_b = (F.substring(f, 1, 2).try_cast("int") for f in (a, b))
    wide = SUBSETS * DIGITS
    at = F.greatest(level_a, level_b)

    def part(f: Column, level: Column) -> Column:
        return F.substr(f, F.lit(4) + (at - level) * wide, F.lit(wide))

    def share(x: Column) -> Column:
        def pick(i: Column, which: str) -> Column:
            return F.substr(x[which], i * DIGITS + 1, F.lit(DIGITS))

        places = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
        same = F.filter(
            places, lambda i: (pick(i, "a") == pick(i, "b")) & (pick(i, "a") != NO_TERM)
        )
        some = F.filter(places, lambda i: (pick(i, "a") != NO_TERM) | (pick(i, "b") != NO_TERM))
        return F.coalesce(F.try_divide(F.size(same), F.size(some)), F.lit(0.0))

    both = F.struct(part(a, level_a).alias("a"), part(b, level_b).alias("b"))
    return (
        F.when(a == b, F.lit(1.0))
        .when(F.abs(level_a - level_b) <= 1, bound(both, share))
        .otherwise(F.lit(0.0))
    )


def with_fingerprints(
    df: DataFrame, columns: dict[str, str], lexicon: DataFrame, max_lexicon: int = MAX_LEXICON
) -> DataFrame:
    """Add the fingerprint of every text column named in ``columns`` (text: result)."""
    if lexicon.limit(max_lexicon + 1).count() <= max_lexicon:
        # one use of the table's column, so that it stays a reference and isn't copied into rows
        df = df.withColumn("_table", lookup_table(lexicon))
        prints = bound(
            F.col("_table"),
            lambda t: F.array(*(fingerprint(kept_by_table(F.col(c), t), F.col(c)) for c in columns)),
        )
    else:
        df = kept_by_join(df, columns, lexicon)
        prints = F.array(*(fingerprint(F.col(out), F.col(c)) for c, out in columns.items()))
    df = df.withColumn("_prints", prints)
    added = {out: F.col("_prints")[i] for i, out in enumerate(columns.values())}
    return df.withColumns(added).drop("_table", "_prints")


def successors(ids: DataFrame) -> DataFrame:
    """Add the row that follows each in descending (key, code) order; after the last, the first.

    ``ids`` has distinct (key, code). The order is cut into ranges; within a range the next row is
    a window's, and a range's last row is followed by the first row of the next range.
    """
    count = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("key").desc_nulls_last(), F.col("code").desc()]
    cut = written(
        ids.repartitionByRange(count, *order).withColumn("range", F.spark_partition_id()), "ranges"
    )
    within = Window.partitionBy("range").orderBy(*order)
    me = F.struct("key", "code")
    placed = cut.withColumns({"place": F.row_number().over(within), "next": F.lead(me).over(within)})
    firsts = placed.filter("place = 1").select("range", me.alias("first"))
    # one row per range
    around = Window.orderBy("range")
    begin = F.first("first").over(around.rowsBetween(Window.unboundedPreceding, 0))
    follows = firsts.select(
        "range", F.coalesce(F.lead("first").over(around), begin).alias("follower")
    )
    return (
        placed.join(F.broadcast(follows), "range")
        .withColumn("next", F.coalesce("next", "follower"))
        .select(*ids.columns, F.col("next.key").alias("next_key"), F.col("next.code").alias("next_code"))
    )
