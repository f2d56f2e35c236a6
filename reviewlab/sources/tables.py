"""Reading the input tables and writing results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reviewlab.sources.schemas import SCHEMAS, TIMESTAMP_FORMAT


@dataclass
class Tables:
    """The five roles. ``reviews`` is None for a set that is still to be scored."""

    products: DataFrame
    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame | None = None


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "csv"
) -> DataFrame:
    """Scan one table.

    CSV needs a schema, whose names are checked against the header. Text that does not parse
    as the declared type becomes null.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt != "csv":
        return reader.format(fmt).load(path)
    if schema is None:
        raise ValueError("a CSV table needs a declared schema")
    return (
        reader.option("header", True)
        .option("enforceSchema", False)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def read_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> Tables:
    """Scan the five (training) or four (scoring) tables named in ``paths``."""
    return Tables(
        **{role: read_table(spark, path, SCHEMAS[role], fmt) for role, path in paths.items()}
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a directory of part files, one per partition."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("timestampFormat", TIMESTAMP_FORMAT)
            .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        )
    writer.format(fmt).save(path)


def export_predictions(
    scored: DataFrame, path: str, key: str = "order_id", prediction: str = "prediction"
) -> None:
    """Write (key, prediction) as CSV straight from the executors."""
    write_table(scored.select(key, prediction), path, fmt="csv")
