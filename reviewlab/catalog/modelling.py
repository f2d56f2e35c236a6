"""Training, tuning, model reports and scoring on the base table.

Fits depend on floating-point order, so these queries have no SQL, save for the reports whose
numbers come from the data alone. All fits use the presets, and all searches the whole grids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.catalog.registry import query
from reviewlab.catalog.roles_sql import BASE, with_roles
from reviewlab.functions.expressions import money_total
from reviewlab.operators import models as md
from reviewlab.operators.joins import attach
from reviewlab.plans import base_table as bt
from reviewlab.plans import scoring as sc
from reviewlab.plans import state as st
from reviewlab.plans import training as tr
from reviewlab.session import scratch_path
from reviewlab.sources import adapters as A
from reviewlab.sources.tables import read_table


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bt.build_base_table(A.tables(spark, sf_dir), payment_types=A.PAYMENT_TYPES)


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = A.tables(spark, sf_dir, labelled=False)
    state = st.learn(bt.clean_orders(tables.orders))
    return sc.scoring_table(tables, state, payment_types=A.PAYMENT_TYPES)


def _train(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = tr.prepare(labelled(spark, sf_dir))
        try:
            return tr.train_and_evaluate(data, name).metrics
        finally:
            data.release()

    run.__name__ = f"train_{name}"
    run.__doc__ = f"Held-out measures of one {name} fit."
    return run


def _tune(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = tr.prepare(labelled(spark, sf_dir))
        try:
            return md.grid_scores(spark, md.tune(data.train, name))
        finally:
            data.release()

    run.__name__ = f"tune_{name}"
    run.__doc__ = f"Mean area under ROC of every {name} grid point."
    return run


for _name in md.CLASSIFIERS:
    query(f"train_{_name}")(_train(_name))
for _name in md.CLASSIFIERS:
    query(f"tune_{_name}")(_tune(_name))


def _tuned(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = tr.prepare(labelled(spark, sf_dir))
        try:
            return tr.tune_and_evaluate(data, name)[1].metrics
        finally:
            data.release()

    run.__name__ = f"tuned_{name}"
    run.__doc__ = f"Held-out measures of the best {name} of the grid."
    return run


for _name in ("lr", "dt"):
    query(f"tuned_{_name}")(_tuned(_name))


@query("best_params")
def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = tr.prepare(labelled(spark, sf_dir))
    try:
        return md.best_params(spark, md.tune(data.train, "dt"))
    finally:
        data.release()


@query("compare_models")
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = tr.prepare(labelled(spark, sf_dir))
    try:
        return tr.compare(data, {name: {} for name in md.CLASSIFIERS})
    finally:
        data.release()


@query("coefficients")
def coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = tr.prepare(labelled(spark, sf_dir))
    try:
        model = tr.train_and_evaluate(data, "svm").model
        return md.coefficients(model, data.train)
    finally:
        data.release()


@query("feature_importances")
def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The levels of the category column summed to one line."""
    data = tr.prepare(labelled(spark, sf_dir))
    try:
        model = tr.train_and_evaluate(data, "rf").model
        return md.grouped_importances(md.feature_importances(model, data.train))
    finally:
        data.release()


# -- reports on importances taken from the data -----------------------------------------------

# A part type's share of revenue stands for the importance of a category level.
SHARES_SQL = """with lines as (
    select p_type, p_size, cast(l_extendedprice as decimal(12,2)) as price
    from lineitem join part on l_partkey = p_partkey),
importances as (
    select 'category_' || p_type as feature,
           cast(sum(price) as double) / (select cast(sum(price) as double) from lines)
               as importance from lines group by p_type
    union all
    select 'size_' || cast(p_size as varchar),
           cast(sum(price) as double) / (select cast(sum(price) as double) from lines)
    from lines group by p_size) """


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = A.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("p_partkey"), "l_extendedprice"
    )
    parts = A.load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    joined = attach(lines, parts, "p_partkey", ["l_orderkey"], how="inner")
    total = lines.agg(money_total("l_extendedprice")).scalar()
    revenue = money_total("l_extendedprice") / total
    by_type = joined.groupBy(F.concat(F.lit("category_"), "p_type").alias("feature"))
    size = F.concat(F.lit("size_"), F.col("p_size").cast("string"))
    by_size = joined.groupBy(size.alias("feature"))
    return by_type.agg(revenue.alias("importance")).unionAll(
        by_size.agg(revenue.alias("importance"))
    )


@query(
    "grouped_importances",
    SHARES_SQL
    + """select case when feature like 'category\\_%' escape '\\' then 'category_product'
         else feature end as feature, round(sum(importance), 9) as importance
         from importances group by 1""",
)
def grouped_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = md.grouped_importances(shares(spark, sf_dir))
    return found.withColumn("importance", F.round("importance", 9))


@query(
    "importances_of",
    SHARES_SQL
    + """select feature, importance from importances
         where feature like 'category\\_%' escape '\\'""",
)
def importances_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return md.importances_of(shares(spark, sf_dir))


# -- scoring ----------------------------------------------------------------------------------


def _export(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        encoder, model = sc.fit_final(labelled(spark, sf_dir), name, spread=False)
        path = scratch_path(spark, "scores-csv")
        sc.score_and_export(encoder, model, unlabelled(spark, sf_dir), path)
        return read_table(spark, path, "order_id long, prediction double")

    run.__doc__ = f"Exported {name} predictions of the unlabelled orders, read from the CSV files."
    return run


query("score_export")(_export("gbt"))
query("score_export_rf")(_export("rf"))


@query("saved_model")
def saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a model saved to the shared folder and loaded again."""
    encoder, model = sc.fit_final(labelled(spark, sf_dir), "dt", spread=False)
    path = scratch_path(spark, "model")
    tables = A.tables(spark, sf_dir, labelled=False)
    sc.save_model(encoder, model, path, st.learn(bt.clean_orders(tables.orders)))
    base = sc.scoring_table(tables, sc.load_state(spark, path), payment_types=A.PAYMENT_TYPES)
    scored = sc.load_model(path).transform(base)
    return scored.select("order_id", "prediction")


@query(
    "score_coverage",
    with_roles(*BASE)
    + """select count(*) as orders, count(s.order_id) as scored,
         count(*) - count(s.order_id) as unscored
         from (select distinct order_id from purchases) a
         left join (select distinct order_id from order_side
                    join item_profile i using (order_id) join payment_agg using (order_id)
                    where i.total_product_density is not null) s using (order_id)""",
)
def score_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with complete features is scored, also with levels unknown to the model."""
    encoder, model = sc.fit_final(labelled(spark, sf_dir), "dt", spread=False)
    scored = sc.score_orders(encoder, model, unlabelled(spark, sf_dir))
    return sc.coverage(A.orders(spark, sf_dir), scored)
