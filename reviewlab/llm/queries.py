"""The registered queries of this subpackage: one per operator, on whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm import (
    chat,
    decontaminate,
    fingerprints,
    jaccard_join,
    licenses,
    merkle,
    pii,
    quality,
    secrets,
    sentencepiece_bpe,
    sql,
    substring_dedup,
    token_files,
    vector_codes,
)
from reviewlab.llm.frames import small, written
from reviewlab.session import scratch_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return done.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _span_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs.select("doc_id", "text"), pii.fit(docs))
    base = F.filter("pii", lambda s: s["base"])
    return found.select(
        "doc_id",
        *(_count(base, kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(_span_text(base), 256).alias("base_sha256"),
        _span_text(F.col("pii")).alias("spans"),
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"), n=4, percent=85)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.default_templates(spark))


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose texts hold the template's control strings."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    says = r"\### Assistant: </turn> ok"
    probe = rows.sparkSession.createDataFrame(
        [(-7, 0, "user", says), (-7, 1, "assistant", says)], rows.schema
    )
    return rows.union(probe)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = chat.format_conversations(with_probe(table(spark, sf_dir, "conversations")))
    lines = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return chat.read_back(done).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs).select(
        "doc_id",
        "n_sentences",
        "n_removed",
        F.char_length(F.coalesce("kept", F.lit(""))).cast("long").alias("kept_chars"),
        F.coalesce("kept", F.lit("")).alias("kept"),
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs, MODEL), MODEL)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, trees).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *(_count(base, kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]),
        F.sha2(_span_text(base), 256).alias("base_sha256"),
        _span_text(F.col("secrets")).alias("spans"),
    )


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), text.alias("text"))
    known = written(fingerprints.lexicon(rows, "text"), "lexicon")
    rows = rows.withColumn("code", F.xxhash64("text"))
    ids = rows.select("key", "code", F.char_length("text").alias("n_chars")).distinct()
    order = written(fingerprints.successors(ids), "order")
    # every text sends the part that is asked for to the row before it
    asked = order.select(
        F.col("next_key").alias("key"),
        F.col("next_code").alias("code"),
        F.col("key").alias("asker"),
        F.col("code").alias("asker_code"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("take"),
    )
    sent = (
        _joined(rows, asked, "key", "code")
        .groupBy("asker", "asker_code")
        .agg(F.max(F.substr("text", F.lit(1), F.col("take"))).alias("part"), F.max("take").alias("take"))
    )
    sent = sent.withColumnsRenamed({"asker": "key", "asker_code": "code"})
    n = F.char_length("text")
    both = _joined(rows, sent, "key", "code").select(
        "key",
        "code",
        "text",
        n.cast("long").alias("n_chars"),
        F.concat(F.substr("text", F.lit(1), n - F.col("take")), "part").alias("edited"),
    )
    columns = {"text": "fingerprint", "edited": "edited_fingerprint"}
    done = fingerprints.with_fingerprints(both, columns, known).select(
        "key", "code", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *columns.values()
    )
    done = written(done, "fingerprints")
    following = done.select(
        F.col("key").alias("next_key"),
        F.col("code").alias("next_code"),
        F.col("fingerprint").alias("next_fingerprint"),
    ).dropDuplicates(["next_key", "next_code"])
    linked = _joined(done, order.drop("n_chars"), "key", "code")
    linked = _joined(linked, following, "next_key", "next_code")
    return linked.select(
        F.col("key").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def _joined(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join in which null keys are equal."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_{k}"]) for k in keys]
    return left.join(renamed, on).drop(*(f"_{k}" for k in keys))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    other = merkle.leaf(docs, columns, n_chars=F.try_add("n_chars", F.lit(1)))
    done = merkle.manifest(
        docs, merkle.leaf(docs, columns), claimed=F.when(tampered, other)
    )
    done = done.withColumn("folded", merkle.fold(F.coalesce("claimed", "leaf")))
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")}
    return done.select(
        "doc_id",
        *(text[c].alias(c) for c in ("leaf", "subroot", "root")),
        F.sha2(text["proof"], 256).alias("proof_sha256"),
        text["folded"].alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_files.write(docs, scratch_path(spark, "token-files"), TOKENIZER)
    return token_files.read(files).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    per_label = done.groupBy("label").agg(F.sum("error").alias("label_error"))
    entries = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return _joined(done, small(per_label), "label").select(
        "vec_id",
        F.array_join(entries, "").alias("code"),
        "error",
        "label_error",
        "codebooks_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_pii,
        op3_jaccard_join,
        op4_license_scan,
        op5_chat_format,
        op6_substring_dedup,
        op7_sentencepiece,
        op8_quality,
        op9_secret_scan,
        op10_imatch,
        op11_merkle,
        op12_token_files,
        op13_vector_codes,
    )
}
ORACLES: dict[str, str] = {
    "op1_decontaminate": sql.DECONTAMINATE,
    "op3_jaccard_join": sql.JACCARD_JOIN,
    "op4_license_scan": sql.license_scan(licenses.TEMPLATES, licenses.DICE),
    "op5_chat_format": sql.CHAT_FORMAT,
    "op10_imatch": sql.imatch(fingerprints),
    "op11_merkle": sql.MERKLE,
    "op13_vector_codes": sql.vector_codes(
        vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    ),
}
