from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reviewlab import session as se
from reviewlab.operators import encoding as en
from reviewlab.plans import scoring as sc
from reviewlab.plans import training as tr


def files(spark):
    return {p.name for p in Path(se.shared_folder(spark).removeprefix("file:")).iterdir()}


@pytest.fixture(scope="module")
def base(spark):
    return spark.range(400).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 17).cast("double").alias("size"),
        F.when(F.col("id") % 3 == 0, "art, toys").otherwise("toys").alias("category"),
        (F.col("id") % 2).cast("int").alias("review"),
    )


def test_scratch_removes_its_own_paths_only(spark):
    kept, mark = se.scratch_path(spark, "kept"), files(spark)
    spark.range(3).write.parquet(kept)
    with se.scratch(spark):
        path = se.scratch_path(spark, "inside")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    assert spark.read.parquet(kept).count() == 3
    se.remove(spark, kept)
    assert files(spark) == mark
    se.remove(spark, kept)  # none there


def test_scratch_removes_after_an_error(spark):
    mark = files(spark)
    with pytest.raises(RuntimeError), se.scratch(spark):
        spark.range(3).write.parquet(se.scratch_path(spark, "inside"))
        raise RuntimeError
    assert files(spark) == mark


def test_staged_rows_are_one_parquet_copy(spark, base):
    mark = files(spark)
    with se.scratch(spark):
        staged = en.stage_for_training(base)
        assert len(files(spark) - mark) == 1 and not staged.is_cached
        assert sorted(staged.collect()) == sorted(base.collect())
        assert "FileScan parquet" in staged.select("size")._jdf.queryExecution().toString()
    assert files(spark) == mark


def test_no_staged_rows_are_left_after_training(spark, base):
    mark = files(spark)
    data = tr.prepare(base)
    assert len(files(spark) - mark) == 1
    metrics = tr.train_and_evaluate(data, "dt", maxDepth=3).metrics
    data.release()
    assert files(spark) == mark
    assert metrics.count() > 0  # the report outlives the rows
    encoder, model = sc.fit_final(base, "dt", maxDepth=3)
    assert files(spark) == mark
    assert model.transform(encoder.transform(base)).count() == 400
