"""Feature vectors, scaling, selection, splits and samples."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.catalog.features import rounded
from reviewlab.catalog.registry import query
from reviewlab.catalog.roles_sql import BASE, with_roles
from reviewlab.operators import encoding as en
from reviewlab.operators import features as ft
from reviewlab.operators import selection as sel
from reviewlab.operators.sets import SetEncoder, level_counts
from reviewlab.plans import base_table as bt
from reviewlab.session import remove, scratch_path
from reviewlab.sources import adapters as A


def spread(df: DataFrame, key: list[str], column: str, names: list[str]) -> DataFrame:
    """A vector column as one column per entry."""
    values = vector_to_array(F.col(column))
    return df.select(*key, *[values.getItem(i).alias(n) for i, n in enumerate(names)])


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
LINE_MEASURES = ["l_quantity", "l_discount", "l_tax"]


@query(
    "assemble",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax from lineitem""",
)
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = en.assemble(A.load(spark, sf_dir, "lineitem"), LINE_MEASURES)
    return spread(vectors, LINE_KEY, "features", LINE_MEASURES)


@query(
    "standardize",
    "select l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(
        f"round({c} / (select stddev_samp({c}) from lineitem), 6) as {c}" for c in LINE_MEASURES
    )
    + " from lineitem",
)
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = en.assemble(A.load(spark, sf_dir, "lineitem"), LINE_MEASURES)
    scaled = spread(en.standardize(vectors), LINE_KEY, "scaledFeatures", LINE_MEASURES)
    return scaled.withColumns({c: F.round(c, 6) for c in LINE_MEASURES})


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = A.load(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = A.load(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return documents.join(labels, "doc_id")


def _levels_sql(column: str, keep_last: bool) -> str:
    cut = "" if keep_last else "where place < n"
    return f"""select '{column}_' || {column} as feature, '{column}' as side, {column} as level
        from (select {column}, row_number() over (order by count(*) desc, {column}) as place,
                     count(*) over () as n from docs group by {column}) {cut}"""


def _formula_sql(keep_last: bool) -> str:
    return f"""with docs as (select d.doc_id, n_chars, lang, source, quality
            from documents d join labels l on d.doc_id = l.doc_id),
        levels as ({_levels_sql("lang", keep_last)} union all
                   {_levels_sql("source", keep_last)})
        select doc_id, cast(quality as double) as label, 'n_chars' as feature,
               cast(n_chars as double) as value from docs
        union all
        select doc_id, cast(quality as double), feature,
               case when (side = 'lang' and lang = level) or (side = 'source' and source = level)
                    then 1.0::double else 0.0::double end
        from docs, levels"""


def _encoded(spark: SparkSession, sf_dir: str, handle_invalid: str) -> DataFrame:
    rows = labelled_documents(spark, sf_dir)
    encoded, _ = en.formula_features(rows, "quality ~ n_chars + lang + source", handle_invalid)
    names = F.array(*[F.lit(n) for n in en.feature_names(encoded)])
    pairs = F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("value"))
    return encoded.select("doc_id", "label", F.inline(pairs))


@query("formula_features", _formula_sql(keep_last=False))
def formula_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry by entry: a number passes, a text column gives a 1/0 entry per level but the last."""
    return _encoded(spark, sf_dir, "skip")


@query("formula_features_keep", _formula_sql(keep_last=True))
def formula_features_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every known level has an entry; unknown ones would be all zeros."""
    return _encoded(spark, sf_dir, "keep")


# -- joined names -----------------------------------------------------------------------------

PROFILE = ("products", "product_features", "clean_products", "items", "item_features", "item_profile")


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = bt.clean_products(A.products(spark, sf_dir))
    return ft.order_item_profile(A.items(spark, sf_dir), products).select("order_id", "category")


@query(
    "category_levels",
    with_roles(*PROFILE)
    + """select level, count(*) as orders, row_number() over (order by count(*) desc, level) - 1
             as place
         from (select unnest(string_split(category, ', ')) as level from item_profile)
         group by level""",
)
def category_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of the category column and their places in the vector."""
    rows = profile(spark, sf_dir)
    model = SetEncoder(inputCol="category", outputCol="category").fit(rows)
    places = [(level, i) for i, level in enumerate(model.getOrDefault("levels"))]
    found = spark.createDataFrame(places, "level string, place long")
    counts = level_counts(rows, "category").withColumnRenamed("rows", "orders")
    return counts.join(found, "level").select("level", "orders", "place")


@query(
    "category_flags",
    with_roles(*PROFILE)
    + """select order_id, 'category_' || unnest(string_split(category, ', ')) as feature
         from item_profile where category is not null""",
)
def category_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of the model input that are 1 for an order: one per name of its category."""
    rows = profile(spark, sf_dir).withColumn("review", F.lit(1))
    encoder = en.build_stages(scale=False, sets=["category"])
    coded = encoder.fit(rows).transform(rows)
    names = F.array(*[F.lit(n) for n in en.feature_names(coded)])
    pairs = F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("value"))
    entries = coded.select("order_id", F.inline(pairs))
    return entries.filter("value = 1").select("order_id", "feature")


CHI_FEATURES = ["l_linenumber", "l_quantity", "l_linestatus"]


def _chi_sql(expressions: dict[str, str]) -> str:
    tables = " union all ".join(
        f"""select '{name}' as feature, cast({e} as varchar) as x, l_returnflag = 'R' as y
            from lineitem"""
        for name, e in expressions.items()
    )
    return "with " + _scores_sql(tables)


def _scores_sql(tables: str) -> str:
    """The test of every feature, from (feature, x, y) rows."""
    return f"""cells as (select feature, x, y, count(*) as n from ({tables})
            group by feature, x, y),
        rows_ as (select feature, x, sum(n) as nx from cells group by feature, x),
        cols as (select feature, y, sum(n) as ny from cells group by feature, y),
        whole as (select feature, sum(n) as n from cells group by feature),
        expected as (select r.feature, r.x, c.y, nx * ny / n::double as e
            from rows_ r join cols c using (feature) join whole using (feature)),
        scores as (select feature, sum((coalesce(n, 0) - e) * (coalesce(n, 0) - e) / e)
                as statistic,
                cast((count(distinct x) - 1) * (count(distinct y) - 1) as integer) as freedom
            from expected left join cells using (feature, x, y) group by feature)
        """


@query(
    "chi2_scores",
    _chi_sql({c: c for c in CHI_FEATURES})
    + "select feature, freedom, round(statistic, 6) as statistic from scores",
)
def chi2_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        "l_quantity",
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("l_linestatus"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
    )
    found = en.chi2_scores(en.assemble(rows, CHI_FEATURES))
    return found.select("feature", "freedom", F.round("statistic", 6).alias("statistic"))


LINES = range(1, 8)


@query(
    "chi2_select",
    _chi_sql({f"line_{i}": f"l_linenumber = {i}" for i in LINES})
    + """select feature, round(statistic, 6) as statistic from scores
         order by statistic desc limit 3""",
)
def chi2_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three of seven 1/0 features with the strongest relation to the label."""
    rows = A.load(spark, sf_dir, "lineitem").select(
        *[F.when(F.col("l_linenumber") == i, 1.0).otherwise(0.0).alias(f"line_{i}") for i in LINES],
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
    )
    vectors = en.assemble(rows, [f"line_{i}" for i in LINES])
    chosen = en.feature_names(en.chi2_select(vectors, 3), "selectedFeatures")
    scores = en.chi2_scores(vectors).filter(F.col("feature").isin(chosen))
    return scores.select("feature", F.round("statistic", 6).alias("statistic"))


@query(
    "cap_levels",
    """with kept as (select o_custkey from orders group by o_custkey
           order by count(*) desc, cast(o_custkey as varchar) limit 20)
       select o_orderkey, case when o_custkey in (select o_custkey from kept)
           then cast(o_custkey as varchar) else 'other' end as customer from orders""",
)
def cap_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer")
    )
    return en.cap_levels(rows, "customer", 20)


# -- selection on the base table --------------------------------------------------------------

# The numeric columns of the base table; what is left are the key, times, the label and the names.
NUMBERS = """order_count recency is_repeated_customer delivery_duration approval_duration nbr_items
    min_price max_price avg_price total_price min_shipping_cost max_shipping_cost avg_shipping_cost
    total_shipping_cost min_item_total_cost max_item_total_cost avg_item_total_cost
    total_item_total_cost min_shipping_to_price_ratio max_shipping_to_price_ratio
    avg_shipping_to_price_ratio total_shipping_to_price_ratio avg_name_length
    avg_description_length avg_product_volume_per_order avg_product_density total_photos
    total_weight_g total_volume total_product_density distincy_category_count dummy_A dummy_N dummy_R
    total_payment_sequential total_payment_value avg_payment_installments
    max_payment_installments monetary_value""".split()


def _binned_sql() -> str:
    numbers = " union all ".join(
        f"""select '{c}' as feature, cast("{c}" as double) as value, review from base"""
        for c in NUMBERS
    )
    return f"""{with_roles(*BASE).rstrip()},
        base as materialized (
            select o.*, i.* exclude (order_id), p.* exclude (order_id),
                   total_payment_value as monetary_value, review
            from order_side o join item_profile i using (order_id)
            join payment_agg p using (order_id) join labels_by_order using (order_id)
            where i.total_product_density is not null),
        names as (select distinct unnest(string_split(category, ', ')) as level from base),
        entries as materialized ({numbers} union all
            select 'category_' || level,
                   case when list_contains(string_split(category, ', '), level)
                        then 1.0::double else 0.0::double end, review from base, names),
        spans as (select feature, min(value) as low, max(value) as high from entries group by feature),
        bins as (select feature, review as y, case when high > low
                then least(floor((value - low) / (high - low) * {sel.BINS}.0::double),
                           {sel.BINS - 1}) else 0 end as x
            from entries join spans using (feature)),
        """ + _scores_sql("select feature, x, y from bins")


@contextmanager
def staged_base(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The base table written once for the passes of learning and testing, and then deleted."""
    base = rounded(bt.build_base_table(A.tables(spark, sf_dir), payment_types=A.PAYMENT_TYPES))
    path = scratch_path(spark, "staged")
    try:
        yield en.stage_for_training(base, path=path, spread=False)
    finally:
        remove(spark, path)


@query(
    "chi2_scores_base",
    _binned_sql() + "select feature, freedom, round(statistic, 6) as statistic from scores",
)
def chi2_scores_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry of the model input, cut into bins, against the label."""
    with staged_base(spark, sf_dir) as base:
        stages = en.build_stages(handle_invalid="keep", scale=False, sets=en.set_columns(base))
        scores = sel.binned_scores(stages.fit(base).transform(base))
        scores = scores.select("feature", "freedom", F.round("statistic", 6).alias("statistic"))
        # one row per entry of the vector
        return spark.createDataFrame(scores.collect(), scores.schema)


@query(
    "chi2_select_base",
    _binned_sql()
    + f"""select feature from (select feature, sign(x - freedom)
              * sqrt(greatest(x - freedom - freedom * ln(x / freedom), 0)) as strength
            from (select feature, freedom, greatest(statistic, {sel.LEAST_STATISTIC}) as x
                  from scores where freedom > 0))
          order by round(strength, {sel.STRENGTH_DECIMALS}) desc, feature
          limit {en.SELECTED_FEATURES}""",
)
def chi2_select_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries that the selection stage of the whole pipeline keeps."""
    with staged_base(spark, sf_dir) as base:
        stages = en.build_stages(
            handle_invalid="keep", sets=en.set_columns(base), select=sel.BinnedSelector()
        )
        kept = en.feature_names(stages.fit(base).transform(base), "selectedFeatures")
    return spark.createDataFrame([(n,) for n in kept], "feature string")


# -- splits -----------------------------------------------------------------------------------


def _bucket_sql(key: str, seed: int) -> str:
    return f"cast('0x' || substr(md5('{seed}|' || {key}), 1, 8) as bigint) % 4294967296"


@query(
    "hash_split",
    f"""select o_orderkey, case when {_bucket_sql("o_orderkey", 123)} < 3006477107
        then 'train' else 'test' end as part from orders""",
)
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "orders").select("o_orderkey")
    train, test = en.split(rows, key="o_orderkey")
    return train.withColumn("part", F.lit("train")).unionAll(
        test.withColumn("part", F.lit("test"))
    )


@query(
    "hash_sample",
    f"""select o_orderkey, o_totalprice from orders
        where {_bucket_sql("o_orderkey", 42)} < 2147483648""",
)
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return en.hash_sample(rows, 0.5, "o_orderkey")


@query("stage_for_training", "select o_orderkey, o_custkey, o_totalprice from orders")
def stage_for_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread evenly and written once to the shared folder."""
    rows = A.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return en.stage_for_training(rows)
