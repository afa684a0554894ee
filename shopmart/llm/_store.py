"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from shopmart.session import checkpoint_dir


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    Cuts the lineage, survives lost executors, and freezes values such as
    generated row ids that must not change when a task is run again.  All
    tables of an application are under ``llm/<application id>``, which can go
    once it has ended.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, thing) -> Callable:
    """Broadcast an object's fields; call the result in a task to get the object (workers need no package installed)."""
    return lent(spark, thing)[0]


def lent(spark: SparkSession, thing) -> tuple[Callable, Broadcast]:
    """As ``shipped``, with the broadcast, which the caller can release."""
    kind, fields = type(thing), spark.sparkContext.broadcast(vars(thing))

    def get():
        copy = kind.__new__(kind)
        copy.__dict__.update(fields.value)
        return copy

    return get, fields
