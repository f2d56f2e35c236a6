from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlab.operators import encoding as en


@pytest.fixture(scope="module")
def rows(spark):
    color = F.when(F.col("id") % 2 == 0, "red").when(F.col("id") % 3 == 0, "blue").otherwise("green")
    return spark.range(600).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 17).cast("double").alias("size"),
        color.alias("color"),
        (F.col("id") % 2).cast("int").alias("review"),
        F.current_timestamp().alias("seen"),
    )


def test_formula_levels_by_frequency(rows):
    encoded, _ = en.formula_features(rows)
    # 300 red, 200 green, 100 blue: the rarest is left out; key and timestamp are no features
    assert en.feature_names(encoded) == ["size", "color_red", "color_green"]
    first = encoded.filter("order_id = 3").select(vector_to_array("features")).head()[0]
    assert first == [3.0, 0.0, 0.0]
    kept, _ = en.formula_features(rows, handle_invalid="keep")
    assert en.feature_names(kept) == ["size", "color_red", "color_green", "color_blue"]


def test_unknown_level(spark, rows):
    new = spark.createDataFrame([(1, 2.0, "pink", 1)], "order_id long, size double, color string, review int")
    _, skip = en.formula_features(rows.drop("seen"))
    _, keep = en.formula_features(rows.drop("seen"), handle_invalid="keep")
    assert skip.transform(new).count() == 0
    got = keep.transform(new.drop("review")).select(vector_to_array("features")).head()[0]
    assert got == [2.0, 0.0, 0.0, 0.0]


def test_names_follow_the_vector(spark):
    df = spark.createDataFrame([("a", 1.0, "x", 1), ("b", 2.0, "y", 0)], "s string, v double, t string, review int")
    encoded, _ = en.formula_features(df, "review ~ s + v + t", "keep")
    assert en.feature_names(encoded) == ["s_a", "s_b", "v", "t_x", "t_y"]


def test_standardize(rows):
    vectors = en.assemble(rows, ["size"])
    got = en.standardize(vectors).select("size", vector_to_array("scaledFeatures")[0].alias("z"))
    values = np.array(got.collect())
    assert values[:, 1] == pytest.approx(values[:, 0] / values[:, 0].std(ddof=1))


def test_chi2_select_finds_the_related_feature(rows):
    df = rows.select(
        (F.col("review") * 1.0).alias("label"),
        (F.col("review") * 1.0).alias("same"),
        (F.floor(F.col("order_id") / 2) % 3).cast("double").alias("noise"),
    )
    vectors = en.assemble(df, ["noise", "same"])
    scores = {r["feature"]: r["statistic"] for r in en.chi2_scores(vectors).collect()}
    assert scores["same"] == pytest.approx(600.0) and scores["noise"] < 5
    assert en.feature_names(en.chi2_select(vectors, 1), "selectedFeatures") == ["same"]


def test_pipeline_with_selection_runs(rows):
    model = en.build_stages(select=2).fit(rows)
    columns = model.transform(rows).columns
    assert {"features", "scaledFeatures", "selectedFeatures"} <= set(columns)


def test_split_is_disjoint_complete_and_stable(rows):
    train, test = en.split(rows)
    a, b = ({r[0] for r in part.select("order_id").collect()} for part in (train, test))
    assert not a & b and len(a | b) == 600
    assert 0.6 < len(a) / 600 < 0.8
    again, _ = en.split(rows.repartition(13, "size"))
    assert {r[0] for r in again.select("order_id").collect()} == a
    other, _ = en.split(rows, seed=124)
    assert {r[0] for r in other.select("order_id").collect()} != a


def test_rows_of_a_key_stay_together(spark):
    df = spark.range(400).select((F.col("id") % 40).alias("order_id"), "id")
    parts = en.split(df, [0.5, 0.3, 0.2])
    keys = [{r[0] for r in p.select("order_id").distinct().collect()} for p in parts]
    assert sum(map(len, keys)) == 40 and sum(p.count() for p in parts) == 400
    folds = en.with_fold(df, 4).groupBy("order_id").agg(F.count_distinct("fold").alias("n"))
    assert folds.filter("n > 1").count() == 0


def test_cap_levels_keeps_every_row(rows):
    capped = en.cap_levels(rows, "color", 1)
    counts = {r["color"]: r["count"] for r in capped.groupBy("color").count().collect()}
    assert counts == {"red": 300, "other": 300}
    assert capped.columns == rows.columns


def test_stage_for_training(rows):
    staged = en.stage_for_training(rows.drop("seen"), partitions=15)
    assert staged.rdd.getNumPartitions() == 15 and staged.count() == 600
    staged.unpersist()


def test_small_samples_are_not_empty(spark):
    keys = spark.range(1_000_000).withColumnRenamed("id", "order_id")
    assert 10 <= en.hash_sample(keys, 0.00004).count() <= 90


def test_staged_as_the_rows_lie(spark, tmp_path):
    rows = spark.range(0, 90, 1, 3)
    staged = en.stage_for_training(rows, path=str(tmp_path / "staged"), spread=False)
    parts = staged.select(F.col("_metadata.file_name").alias("file"), "id").collect()
    files = {f: sorted(r["id"] for r in parts if r["file"] == f) for f in {r["file"] for r in parts}}
    assert sorted(files.values()) == [[*range(0, 30)], [*range(30, 60)], [*range(60, 90)]]
