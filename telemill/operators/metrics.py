"""Message counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.operators.clean import has_invalid_port


def counters() -> list[Column]:
    """All messages, and those with an invalid port."""
    invalid = has_invalid_port(F.col("values"), F.col("portnum"))
    return [
        F.count(F.lit(1)).alias("valid_num"),
        F.count_if(invalid).alias("invalid_num"),
    ]


def message_metrics(messages: DataFrame) -> DataFrame:
    return messages.agg(*counters())


def observed(messages: DataFrame, name: str = "messages") -> DataFrame:
    """Counts while the messages pass; the numbers show in the progress of a streaming query."""
    return messages.observe(name, *counters())
