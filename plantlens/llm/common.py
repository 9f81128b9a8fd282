"""Tables of a scale-factor folder and written intermediate tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.session import fresh_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: cuts the
    lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, value) -> Callable:
    """A broadcast of ``value`` with its class; call the result inside a
    task. The caller bounds the size."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def with_text(changed: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """Documents again from (row, text): the given columns in their order,
    with n_chars, where there is one, counted anew."""
    text = F.col("text").alias(text_col)
    kinds = dict(changed.select("row.*").dtypes)
    size = F.length("text").cast(kinds.get("n_chars", "bigint")).alias("n_chars")
    return changed.select(
        *(text if c == text_col else size if c == "n_chars" else F.col(f"row.`{c}`") for c in columns)
    )
