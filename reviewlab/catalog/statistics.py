"""Quantiles, outliers, correlation and collinearity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.catalog.features import rounded
from reviewlab.catalog.registry import query
from reviewlab.catalog.roles_sql import BASE, with_roles
from reviewlab.operators import statistics as st
from reviewlab.plans import base_table as bt
from reviewlab.sources import adapters as A

MEASURES = ["price", "shipping_cost"]
PROBABILITIES = [0.01, 0.25, 0.5, 0.9]


@query(
    "quantiles",
    with_roles("items")
    + " union all ".join(
        f"""select '{c}' as "column", {p}::double as p,
            round(quantile_cont({c}, {p}), 6) as value from items"""
        for c in MEASURES
        for p in PROBABILITIES
    ),
)
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = st.quantiles(A.items(spark, sf_dir), MEASURES, PROBABILITIES)
    return found.withColumn("value", F.round("value", 6))


@query(
    "quartiles",
    with_roles("items")
    + "select "
    + ", ".join(
        f"round(quantile_cont({c}, {p}), 6) as {c}_q{i}"
        for c in MEASURES
        for i, p in ((1, 0.25), (3, 0.75))
    )
    + " from items",
)
def quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both quartiles of each measure as one row."""
    found = st.quantiles(A.items(spark, sf_dir), MEASURES, [0.25, 0.75])
    cells = [
        F.round(F.max(F.when((F.col("column") == c) & (F.col("p") == p), F.col("value"))), 6)
        .alias(f"{c}_q{i}")
        for c in MEASURES
        for i, p in ((1, 0.25), (3, 0.75))
    ]
    return found.agg(*cells)


@query("quartiles_approx")
def quartiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate quartiles, with the share of rows at or below them as found in the data."""
    rows = A.items(spark, sf_dir).select(*MEASURES)
    found = st.quartiles(rows, MEASURES, 0.05)
    shares = [
        F.avg((F.col(c) <= q).cast("int")).alias(f"{c}_q{i}")
        for c, pair in found.items()
        for i, q in ((1, pair[0]), (3, pair[1]))
    ]
    return rows.agg(*shares)


QUARTILES_SQL = """q as (select quantile_cont(price, 0.25) as q1, quantile_cont(price, 0.75) as q3
    from items) """


@query(
    "iqr_outliers",
    with_roles("items").rstrip()
    + ", "
    + QUARTILES_SQL
    + """select order_id, order_item_id, product_id, price, shipping_cost from items, q
         where price < q1 or price > q3""",
)
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows outside the quartiles themselves."""
    return st.iqr_outliers(A.items(spark, sf_dir), "price")


def _outliers_sql(k: float) -> str:
    cells = " union all ".join(
        f"""select '{c}' as "column", round(q1, 6) as q1, round(q3, 6) as q3,
            round(q1 - {k} * (q3 - q1), 6) as low, round(q3 + {k} * (q3 - q1), 6) as high,
            (select count(*) from items
             where {c} < q1 - {k}::double * (q3 - q1) or {c} > q3 + {k}::double * (q3 - q1))
                as outliers
            from (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3
                  from items)"""
        for c in MEASURES
    )
    return with_roles("items") + cells


def _outliers(spark: SparkSession, sf_dir: str, k: float) -> DataFrame:
    found = st.outlier_counts(A.items(spark, sf_dir), MEASURES, error=0.0, k=k)
    return found.withColumns({c: F.round(c, 6) for c in ("q1", "q3", "low", "high")})


@query("outlier_counts", _outliers_sql(0.0))
def outlier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outliers(spark, sf_dir, 0.0)


@query("outlier_counts_fence", _outliers_sql(1.5))
def outlier_counts_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outliers(spark, sf_dir, 1.5)


@query(
    "box_stats",
    with_roles("items")
    + " union all ".join(
        f"""select '{c}' as "column", min({c}) as min, round(quantile_cont({c}, 0.25), 6) as q1,
            round(quantile_cont({c}, 0.5), 6) as median,
            round(quantile_cont({c}, 0.75), 6) as q3, max({c}) as max from items"""
        for c in MEASURES
    ),
)
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = st.box_stats(A.items(spark, sf_dir), MEASURES)
    return found.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


# -- correlation and collinearity -------------------------------------------------------------

# Both reports read the base table with one row per payment: only there are the value of a payment
# and of its installments, which the reports name, columns of their own.
PAYMENT_BASE = (
    with_roles(*BASE, "payment_features").rstrip()
    + """, base as (select * from order_side join item_profile i using (order_id)
         join (select distinct * from payment_features where installment_value is not null)
             using (order_id)
         join labels_by_order using (order_id)
         where i.total_product_density is not null) """
)


def payment_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = A.tables(spark, sf_dir)
    base = bt.build_base_table(
        tables, payment_types=A.PAYMENT_TYPES, payment_grain="row", keep_helpers=True
    )
    return rounded(base)


@query(
    "correlation_matrix",
    PAYMENT_BASE
    + " union all ".join(
        f"""select '{a}' as "row", '{b}' as col, round(corr({a}, {b}), 6) as r from base"""
        for a in st.CORRELATION_COLUMNS
        for b in st.CORRELATION_COLUMNS
    ),
)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = st.correlation_matrix(payment_base(spark, sf_dir), st.CORRELATION_COLUMNS)
    return found.withColumn("r", F.round("r", 6))


VIF_THREE = ["price", "shipping_cost", "order_item_id"]


def _vif_sql(centered: bool) -> str:
    """Closed form of the inverse 3 x 3 cosine (or correlation) matrix."""
    a, b, c = VIF_THREE

    def r(x: str, y: str) -> str:
        if centered:
            return f"corr({x}, {y})"
        return f"sum({x} * {y}) / sqrt(sum({x} * {x}) * sum({y} * {y}))"

    return (
        with_roles("items").rstrip()
        + f""", r as (select {r(a, b)} as ab, {r(a, c)} as ac, {r(b, c)} as bc from items),
        d as (select *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc as det from r)
        select '{a}' as feature, round((1 - bc * bc) / det, 6) as vif from d union all
        select '{b}', round((1 - ac * ac) / det, 6) from d union all
        select '{c}', round((1 - ab * ab) / det, 6) from d"""
    )


@query("vif", _vif_sql(False))
def vif(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = st.vif(A.items(spark, sf_dir), VIF_THREE)
    return found.withColumn("vif", F.round("vif", 6))


@query("vif_centered", _vif_sql(True))
def vif_centered(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = st.vif(A.items(spark, sf_dir), VIF_THREE, center=True)
    return found.withColumn("vif", F.round("vif", 6))


def _inverse_sql(columns: list[str]) -> str:
    """The diagonal of the inverse cosine matrix, one column swept out of it after the other."""
    k = len(columns)
    sums = ", ".join(
        f"sum({columns[i]}::double * {columns[j]}::double) as p{i}_{j}"
        for i in range(k)
        for j in range(i, k)
    )
    cells = " union all ".join(
        f"""select {i} as i, {j} as j,
            p{min(i, j)}_{max(i, j)} / sqrt(p{i}_{i} * p{j}_{j}) as v from sums"""
        for i in range(k)
        for j in range(k)
    )
    sweeps = "".join(
        f""", m{c + 1} as materialized (
            select m.i, m.j, case when m.i = {c} and m.j = {c} then 1 / d.v
                when m.i = {c} then m.v / d.v when m.j = {c} then -m.v / d.v
                else m.v - r.v * l.v / d.v end as v
            from m{c} m join m{c} d on d.i = {c} and d.j = {c}
            join m{c} r on r.i = m.i and r.j = {c} join m{c} l on l.i = {c} and l.j = m.j)"""
        for c in range(k)
    )
    names = ", ".join(f"'{c}'" for c in columns)
    return f""", sums as materialized (select {sums} from base), m0 as materialized ({cells})
        {sweeps} select [{names}][i + 1] as feature, round(v, 4) as vif from m{k} where i = j"""


@query("vif_base_table", PAYMENT_BASE.rstrip() + _inverse_sql(st.VIF_COLUMNS))
def vif_base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All thirteen columns of the report on the base table."""
    found = st.vif(payment_base(spark, sf_dir), st.VIF_COLUMNS)
    return found.withColumn("vif", F.round("vif", 4))
