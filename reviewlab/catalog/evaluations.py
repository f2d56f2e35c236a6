"""Classifier measures, on a score and a prediction taken from the line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.catalog.registry import query
from reviewlab.operators import evaluation as ev
from reviewlab.sources import adapters as A

SCORED_SQL = """with scored as (
    select l_extendedprice as score, l_discount * 10 as probability,
           case when l_returnflag = 'R' then 1 else 0 end as label,
           case when l_discount > 0.045 then 1 else 0 end as prediction
    from lineitem) """


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.load(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("score"),
        (F.col("l_discount") * 10).alias("probability"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.when(F.col("l_discount") > 0.045, 1).otherwise(0).alias("prediction"),
    )


CELLS = """cells as (
    select count(*) filter (prediction = 1 and label = 1) as tp,
           count(*) filter (prediction = 1 and label = 0) as fp,
           count(*) filter (prediction = 0 and label = 1) as fn,
           count(*) filter (prediction = 0 and label = 0) as tn from scored) """


@query("confusion_matrix", SCORED_SQL.rstrip() + ", " + CELLS + "select * from cells")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_matrix(scored(spark, sf_dir))


@query(
    "classification_rates",
    SCORED_SQL.rstrip()
    + ", "
    + CELLS
    + """select (tp + tn) / (tp + fp + fn + tn) as accuracy, tp / (tp + fn) as sensitivity,
         tn / (tn + fp) as specificity, tp / (tp + fp) as "precision" from cells""",
)
def classification_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.classification_rates(scored(spark, sf_dir))


@query(
    "classification_rates_one_class",
    SCORED_SQL
    + """select avg(label) as accuracy, 1.0::double as sensitivity, 0.0::double as specificity,
         avg(label) as "precision" from scored""",
)
def classification_rates_one_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row predicted positive."""
    return ev.classification_rates(scored(spark, sf_dir).withColumn("prediction", F.lit(1)))


@query(
    "weighted_prf",
    SCORED_SQL.rstrip()
    + ", "
    + CELLS
    + """select round(((tp + fn) * (tp / (tp + fp)) + (tn + fp) * (tn / (tn + fn)))
             / (tp + fp + fn + tn), 9) as weighted_precision,
         round((tp + tn) / (tp + fp + fn + tn), 9) as weighted_recall,
         round(((tp + fn) * (2.0::double * tp / (2 * tp + fp + fn))
              + (tn + fp) * (2.0::double * tn / (2 * tn + fp + fn)))
             / (tp + fp + fn + tn), 9) as f1 from cells""",
)
def weighted_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.weighted_prf(scored(spark, sf_dir))
    return found.select([F.round(c, 9).alias(c) for c in found.columns])


@query(
    "roc_curve",
    SCORED_SQL.rstrip()
    + """, totals as (select sum(label) as p, count(*) - sum(label) as n from scored)
         select distinct score as threshold,
         cast(sum(1 - label) over w as bigint) / cast(n as bigint) as fpr,
         cast(sum(label) over w as bigint) / cast(p as bigint) as tpr
         from scored, totals window w as (order by score desc)""",
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.roc_curve(scored(spark, sf_dir))


def _auc_sql(score: str) -> str:
    return (
        SCORED_SQL.rstrip()
        + f""", ranked as (select label, rank() over (order by {score})
               + (count(*) over (partition by {score}) - 1) / 2 as place from scored)
         select round((sum(place) filter (label = 1)
                - sum(label) * (sum(label) + 1) / 2)
                / (sum(label) * (count(*) - sum(label))), 9) as auc from ranked"""
    )


@query("auc_roc", _auc_sql("score"))
def auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.auc_roc(scored(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))


@query("auc_roc_ties", _auc_sql("probability"))
def auc_roc_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven different scores only, each held by many rows of both classes."""
    found = ev.auc_roc(scored(spark, sf_dir), score="probability")
    return found.select(F.round("auc", 9).alias("auc"))


@query(
    "log_loss",
    SCORED_SQL
    + """select round(avg(case when label = 1
             then -ln(least(greatest(probability, 1e-15), 1 - 1e-15::double))
             else -ln(1 - least(greatest(probability, 1e-15), 1 - 1e-15::double)) end), 6)
         as log_loss from scored""",
)
def log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities from 0 to 1 with both ends present, which are clipped."""
    found = ev.log_loss(scored(spark, sf_dir), "probability")
    return found.select(F.round("log_loss", 6).alias("log_loss"))
