from __future__ import annotations

from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlab.catalog import QUERIES
from reviewlab.operators import encoding as en
from reviewlab.operators import selection as sel


@pytest.fixture(scope="module")
def rows(spark):
    label = F.col("id") % 2
    return spark.range(4000).select(
        F.col("id").alias("order_id"),
        (F.col("id") + label * 1500.0).alias("shifted"),  # a value of its own in every row
        (F.hash("id") % 1000).cast("double").alias("noise"),
        F.lit(7.0).alias("constant"),
        F.when(F.col("id") % 10 < 5, "red").otherwise("blue").alias("color"),
        label.cast("int").alias("review"),
    )


@pytest.fixture(scope="module")
def encoded(rows):
    return en.formula_features(rows, handle_invalid="keep")[0]


def plain_chi2(values, labels, bins):
    low, high = min(values), max(values)
    cut = [min(int((v - low) / (high - low) * bins), bins - 1) if high > low else 0 for v in values]
    cells, xs, ys = Counter(zip(cut, labels)), Counter(cut), Counter(labels)
    expected = {(x, y): xs[x] * ys[y] / len(values) for x in xs for y in ys}
    return (
        sum((cells[c] - e) ** 2 / e for c, e in expected.items()),
        (len(xs) - 1) * (len(ys) - 1),
    )


@pytest.mark.parametrize("bins", [2, 32])
def test_scores_as_counted_plainly(encoded, bins):
    got = {r["feature"]: r for r in sel.binned_scores(encoded, bins=bins).collect()}
    data = encoded.select(vector_to_array("features").alias("x"), "label").collect()
    x, y = np.array([r["x"] for r in data]), [r["label"] for r in data]
    for i, name in enumerate(en.feature_names(encoded)):
        statistic, freedom = plain_chi2(x[:, i].tolist(), y, bins)
        assert got[name]["statistic"] == pytest.approx(statistic), name
        assert got[name]["freedom"] == freedom and got[name]["place"] == i


def test_constant_entries_are_never_kept(encoded):
    scores = sel.binned_scores(encoded)
    kept = [r["feature"] for r in sel.strongest(scores, 10).collect()]
    assert kept[0] == "shifted" and "constant" not in kept
    assert len(kept) == len(en.feature_names(encoded)) - 1


def test_strength_tells_apart_what_p_values_do_not(spark):
    far = spark.createDataFrame([(5e5, 31), (6e5, 31), (6e5, 1)], "s double, f int")
    got = [r[0] for r in far.select(sel.strength(F.col("s"), F.col("f"))).collect()]
    assert got[0] < got[1] < got[2]
    none = spark.createDataFrame([(0.0, 0)], "s double, f int")
    assert none.select(sel.strength(F.col("s"), F.col("f"))).head()[0] is None


def test_a_stage_of_the_pipeline(rows, tmp_path):
    stages = en.build_stages(handle_invalid="keep", select=sel.BinnedSelector(numTopFeatures=2))
    model = stages.fit(rows)
    model.write().save(str(tmp_path / "encoder"))
    for encoder in (model, PipelineModel.load(str(tmp_path / "encoder"))):
        done = encoder.transform(rows)
        names = en.feature_names(done, "selectedFeatures")
        assert len(names) == 2 and "shifted" in names
        # the selected entries are the values themselves, not their bins
        at = names.index("shifted")
        row = done.filter("order_id = 7").select(vector_to_array("selectedFeatures")).head()[0]
        assert row[at] == 1507.0


def test_no_rows(encoded):
    assert sel.bounds(encoded.limit(0)) == ([], [])
    assert sel.binned_scores(encoded.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sel.BinnedSelector().fit(encoded.limit(0))


def test_base_table_is_built_once_for_all_passes(spark, monkeypatch, tmp_path):
    days = [F.lit(f"2024-01-0{d}").cast("timestamp_ntz") for d in range(1, 5)]
    n = F.col("id")
    spark.range(300).select(
        n.alias("o_orderkey"), (n % 50).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        days[0].alias("o_orderdate"),
        F.concat((n % 5 + 1).cast("string"), F.lit("-X")).alias("o_orderpriority"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(900).select(
        (n % 300).alias("l_orderkey"), (n % 40).alias("l_partkey"),
        (n / 300).cast("int").alias("l_linenumber"), (n * 1.5 + 1).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.substring(F.lit("ANR"), (n % 3 + 1).cast("int"), F.lit(1)).alias("l_returnflag"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(40).select(
        n.alias("p_partkey"), F.concat(F.lit("name"), n).alias("p_name"), F.lit("b").alias("p_brand"),
        F.concat(F.lit("T"), n % 3).alias("p_type"), (n % 10 + 1).cast("int").alias("p_size"),
    ).write.parquet(str(tmp_path / "part.parquet"))
    read, writes = en.stage_for_training, []

    def staged(df, **options):
        writes.append(options["path"])
        return read(df, **options)

    monkeypatch.setattr(en, "stage_for_training", staged)
    for name in ("chi2_scores_base", "chi2_select_base"):
        assert QUERIES[name](spark, str(tmp_path)).count() > 0
    assert len(writes) == 2 and not any(Path(p).exists() for p in writes)
