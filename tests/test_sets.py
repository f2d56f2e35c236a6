"""Columns of joined names: an entry per name, unknown and bounded names, saving."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlab.operators import encoding as en
from reviewlab.operators.sets import SetEncoder, names_of

ROWS = [
    (1, "art, toys", 1),
    (2, "toys", 0),
    (3, "books, toys", 1),
    (4, None, 0),
    (5, "", 1),
    (6, "art", 0),
    (7, "art.x", 1),
    (7, "art, art", 1),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "order_id int, category string, review int")


def test_levels_by_frequency_then_name(rows):
    model = SetEncoder(inputCol="category", outputCol="flags").fit(rows)
    assert model.getOrDefault("levels") == ["art", "toys", "art.x", "books"]
    got = model.transform(rows).select("order_id", vector_to_array("flags").alias("v")).collect()
    assert [tuple(r.v) for r in got][:5] == [(1, 1, 0, 0), (0, 1, 0, 0), (0, 1, 0, 1), (0,) * 4, (0,) * 4]
    assert got[-1].v == [1, 0, 0, 0]
    bounded = SetEncoder(inputCol="category", outputCol="flags", maxLevels=2).fit(rows)
    assert bounded.getOrDefault("levels") == ["art", "toys"]


def test_formula_has_an_entry_per_name(spark, rows, tmp_path):
    fitted = en.build_stages(sets=["category"]).fit(rows)
    coded = fitted.transform(rows)
    assert en.feature_names(coded) == ["category_art", "category_toys", "category_art.x", "category_books"]
    assert coded.count() == len(ROWS)
    new = spark.createDataFrame([(9, "toys, never seen", 1)], rows.schema)
    assert fitted.transform(new).select(vector_to_array("features")).first()[0] == [0, 1, 0, 0]
    fitted.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).transform(rows)
    a, b = (d.select("order_id", "features").orderBy("order_id", F.col("features").cast("string")).collect() for d in (coded, loaded))
    assert a == b and en.feature_names(loaded) == en.feature_names(coded)


def test_no_names_at_all(spark):
    empty = spark.createDataFrame([(1, None, 2.0, 1), (2, "", 3.0, 0)], "order_id int, category string, x double, review int")
    coded = en.build_stages(sets=["category"], scale=False).fit(empty).transform(empty)
    assert en.feature_names(coded) == ["x"]
    assert empty.select(names_of("category").alias("n")).filter("size(n) > 0").isEmpty()


def test_only_text_columns_are_sets(spark, rows):
    assert en.set_columns(rows) == ["category"]
    assert en.set_columns(rows.withColumn("category", F.lit(1))) == []
    kept = en.bound_levels(rows, 1, "order_id", sets=["category"])
    assert {r.category for r in kept.collect()} == {r[1] for r in ROWS}
