"""Cleaning operators and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.catalog.registry import query
from reviewlab.catalog.roles_sql import BASE, with_roles
from reviewlab.operators import cleaning as cl
from reviewlab.operators import features as ft
from reviewlab.operators import profiling as pr
from reviewlab.plans import base_table as bt
from reviewlab.sources import adapters as A

# Line items with nulls and NaN put in, the same way on both sides.
GAPS_SQL = """with gaps as (
    select l_orderkey, l_linenumber,
           case when l_orderkey % 11 <> 0 then l_quantity end as quantity,
           case when l_linenumber = 3 then 'NaN'::double
                when l_orderkey % 7 <> 0 then l_extendedprice end as price,
           case when l_returnflag <> 'A' then l_returnflag end as flag
    from lineitem) """


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_orderkey") % 11 != 0, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linenumber") == 3, F.lit(float("nan")))
        .when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice"))
        .alias("price"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("flag"),
    )


# -- cleaning ---------------------------------------------------------------------------------


@query(
    "parse_timestamps",
    """with texts as (
           select o_orderkey, case when o_orderkey % 17 = 0 then 'bad'
                when o_orderkey % 13 = 0 then ''
                else strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S')
                end as bought from orders)
       select o_orderkey, try_strptime(bought, '%Y-%m-%d %H:%M:%S') as bought from texts""",
)
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    seconds = (key % 86400).cast("int")
    text = F.date_format(F.timestamp_add("SECOND", seconds, "o_orderdate"), "yyyy-MM-dd HH:mm:ss")
    rows = A.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 17 == 0, "bad").when(key % 13 == 0, "").otherwise(text).alias("bought"),
    )
    return cl.parse_timestamps(rows, ["bought"])


@query(
    "drop_nulls",
    GAPS_SQL
    + """select * from gaps where quantity is not null and price is not null
         and not isnan(price) and flag is not null""",
)
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.drop_nulls(gaps(spark, sf_dir))


@query("drop_nulls_column", GAPS_SQL + "select flag from gaps where flag is not null")
def drop_nulls_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.drop_nulls(gaps(spark, sf_dir).select("flag"), subset=["flag"])


@query(
    "drop_nulls_all",
    GAPS_SQL
    + """select * from gaps where not (quantity is null and flag is null
         and (price is null or isnan(price)))""",
)
def drop_nulls_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.drop_nulls(gaps(spark, sf_dir), how="all", subset=["quantity", "price", "flag"])


@query(
    "drop_duplicates",
    """select distinct * from (
           select l_orderkey, l_linenumber, l_returnflag, l_quantity from lineitem
           union all select l_orderkey, l_linenumber, l_returnflag, l_quantity from lineitem)""",
)
def drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "lineitem")
    rows = rows.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return cl.drop_duplicates(rows.unionAll(rows))


@query("distinct_values", "select distinct l_partkey from lineitem order by l_partkey")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.distinct_values(A.load(spark, sf_dir, "lineitem"), "l_partkey")


@query(
    "drop_columns",
    "select l_orderkey, l_linenumber, l_shipdate from lineitem",
)
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The columns that go; the last one does not exist.
    gone = (
        "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag "
        "l_linestatus dummy_not_defined"
    ).split()
    return cl.drop_columns(A.load(spark, sf_dir, "lineitem"), gone)


@query("project", "select o_orderkey as order_id, o_totalprice as total from orders")
def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"order_id": "o_orderkey", "total": "o_totalprice"}
    return cl.project(A.load(spark, sf_dir, "orders"), names)


# -- counts -----------------------------------------------------------------------------------

GAP_COLUMNS = ["l_orderkey", "l_linenumber", "quantity", "price", "flag"]


@query(
    "null_counts",
    GAPS_SQL
    + "select "
    + ", ".join(f"count(*) - count({c}) as {c}" for c in GAP_COLUMNS)
    + " from gaps",
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.null_counts(gaps(spark, sf_dir))


@query(
    "null_nan_counts",
    GAPS_SQL
    + """select count(*) - count(l_orderkey) as l_orderkey,
         count(*) - count(l_linenumber) as l_linenumber,
         count(*) filter (quantity is null or isnan(quantity)) as quantity,
         count(*) filter (price is null or isnan(price)) as price,
         count(*) - count(flag) as flag from gaps""",
)
def null_nan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.null_nan_counts(gaps(spark, sf_dir))


@query(
    "distinct_count",
    """select count(distinct l_partkey) as l_partkey, count(distinct l_orderkey) as l_orderkey,
       count(distinct l_returnflag) as l_returnflag from lineitem""",
)
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "lineitem")
    return pr.distinct_count(rows, ["l_partkey", "l_orderkey", "l_returnflag"])


@query("distinct_count_approx")
def distinct_count_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.load(spark, sf_dir, "lineitem")
    return pr.distinct_count(rows, ["l_partkey", "l_orderkey"], approximate=True)


@query(
    "distinct_count_merged",
    """select unnest(['l_partkey', 'l_orderkey']) as "column",
       unnest([count(distinct l_partkey), count(distinct l_orderkey)]) as exact,
       true as within from lineitem""",
)
def distinct_count_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts, and whether merged sketches of parts come within 5 % (three errors) of them."""
    names = ["l_partkey", "l_orderkey"]
    rows = A.load(spark, sf_dir, "lineitem")
    parts = pr.distinct_sketches(rows, names, by=["l_returnflag"])
    found = pr.merged_distinct(parts, names).unpivot([], names, "column", "estimate")
    exact = pr.distinct_count(rows, names).unpivot([], names, "column", "exact")
    near = F.abs(F.col("estimate") - F.col("exact")) <= 0.05 * F.col("exact")
    return exact.join(found, "column").select("column", "exact", near.alias("within"))


@query("row_count", 'select count(*) as "rows" from lineitem')
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.row_count(A.load(spark, sf_dir, "lineitem"))


@query(
    "grain_check",
    """select cast(sum(n) as bigint) as "rows", count(*) as keys,
              count(*) filter (n > 1) as repeated_keys
       from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)""",
)
def grain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.grain_check(A.load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "key_repeats",
    """select l_orderkey, l_linenumber, count(*) as "rows" from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)
def key_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.key_repeats(A.load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- frequencies ------------------------------------------------------------------------------


@query("value_counts", "select p_type, count(*) as n from part group by p_type")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.value_counts(A.load(spark, sf_dir, "part"), "p_type")


@query(
    "share_of_total",
    """select l_returnflag, count(*) as n,
              round(count(*) * 100.0::double / sum(count(*)) over (), 1) as percent
       from lineitem group by l_returnflag""",
)
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.share_of_total(A.load(spark, sf_dir, "lineitem"), "l_returnflag")


@query(
    "pivot_counts",
    with_roles(*BASE)
    + """select is_repeated_customer, count(*) filter (review = 0) as review_0,
         count(*) filter (review = 1) as review_1
         from order_side join labels_by_order using (order_id) group by is_repeated_customer""",
)
def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = ft.binary_label(A.reviews(spark, sf_dir)).select("order_id", "review")
    joined = bt.order_side(A.orders(spark, sf_dir)).join(labels, "order_id")
    return pr.pivot_counts(joined, "is_repeated_customer", "review", [0, 1], "review_")


@query(
    "histogram",
    """with scores as (select cast(substr(o_orderpriority, 1, 1) as double) as x from orders),
       edges as (select min(x) as lo, max(x) as hi from scores)
       select cast(least(floor((x - lo) / ((hi - lo) / 5)), 4) as integer) as bin,
              min(lo) + cast(least(floor((x - lo) / ((hi - lo) / 5)), 4) as integer)
                  * ((min(hi) - min(lo)) / 5) as low,
              min(lo) + (cast(least(floor((x - lo) / ((hi - lo) / 5)), 4) as integer) + 1)
                  * ((min(hi) - min(lo)) / 5) as high,
              count(*) as n
       from scores, edges group by least(floor((x - lo) / ((hi - lo) / 5)), 4)""",
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.histogram(A.reviews(spark, sf_dir), "review_score", 5)


# -- descriptions -----------------------------------------------------------------------------

DESCRIBED = ["price", "shipping_cost", "order_item_id"]


@query(
    "describe",
    with_roles("items")
    + " union all ".join(
        f"""select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean,
            round(stddev_samp({c}), 4) as stddev, cast(min({c}) as double) as min,
            cast(max({c}) as double) as max from items"""
        for c in DESCRIBED
    ),
)
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = pr.describe(A.items(spark, sf_dir), DESCRIBED)
    return report.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(
    "describe_text",
    """select 'p_type' as "column", count(p_type) as count, min(p_type) as min, max(p_type) as max
       from part union all
       select 'p_brand', count(p_brand), min(p_brand), max(p_brand) from part""",
)
def describe_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.describe_text(A.load(spark, sf_dir, "part"), ["p_type", "p_brand"])
