"""Parameterised SQL over the price table."""

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tickwell.schema import TABLE


def register(prices: DataFrame, name: str = TABLE) -> None:
    prices.createOrReplaceTempView(name)


def query(spark: SparkSession, text: str, **parameters: Any) -> DataFrame:
    """Run ``text`` with its ``:name`` markers bound as values, or as names inside ``IDENTIFIER(:name)``."""
    return spark.sql(text, args=parameters)
