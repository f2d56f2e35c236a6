"""A training corpus from raw documents: five stages, each one operator of reviewlab.llm.

Every stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm import decontaminate, jaccard_join, quality, secrets, sentencepiece_bpe
from reviewlab.llm.frames import written
from reviewlab.llm.queries import MODEL, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier scores 0.5 or more."""
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select(COLUMNS), trees, out="quality_score")
    return scored.filter("quality_score >= 0.5").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near duplicates (five-word shingles, similarity 0.8 or
    more): of those with the smallest id, none coming last, one text and one row of it. Texts are
    compared, whatever their ids; documents without words stay."""
    rows = docs.select(COLUMNS).withColumn("_code", F.xxhash64("text"))
    groups = jaccard_join.groups(rows, n=5, percent=80, key="_code").filter("n_shingles > 0")
    groups = written(groups.select("_code", "component_id").distinct(), "groups")
    # the first row of every text, then of every group; no text is in these
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "lang", "source", "n_chars")
    first = rows.groupBy("_code").agg(F.min(place).alias("place")).join(groups, "_code")
    first = first.groupBy("component_id").agg(F.min(F.struct("place", "_code")).alias("f"))
    first = written(first.select("f.place", "f._code"), "first")
    same = rows["doc_id"].eqNullSafe(F.col("place.doc_id")) & (rows["_code"] == first["_code"])
    kept = rows.join(first, same).select(rows["_code"], "place", "text").dropDuplicates(["_code"])
    kept = kept.select(*(F.col("text") if c == "text" else F.col(f"place.{c}") for c in COLUMNS))
    return kept.union(rows.join(groups, "_code", "left_anti").select(COLUMNS))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of the benchmark, by their texts, not their ids."""
    rows = docs.select(COLUMNS).withColumn("_code", F.xxhash64("text"))
    checked = decontaminate.decontaminate(rows, table(spark, sf_dir, "benchmark"), key="_code")
    dropped = checked.filter("n_hit > 0").select("_code").distinct()
    return rows.join(dropped, "_code", "left_anti").select(COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in a text by [SECRET]; n_chars follows the text."""
    found = secrets.scan(docs.select(COLUMNS), out="found_secrets")
    clean = secrets.redact(found, "text", "found_secrets")
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text; the ids decode to the text again."""
    done = sentencepiece_bpe.encode(docs.select(COLUMNS), MODEL)
    return done.select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", remove_contaminated),
    ("secret_scans", mask_secrets),
    ("sentencepiece", tokenize),
]

# SQL can't express the classifier and the encoding; tests hold run() against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
