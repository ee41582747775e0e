"""Registration of queries with their SQL, and the tables that stand for series and stores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import rounded

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, and the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lightcurve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as series: one for each user."""
    e = table(spark, sf_dir, "events")
    days = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(86400e6)
    return e.select(F.col("user_id").alias("series_id"), days.alias("t"), F.col("value").alias("flux"), (1 + (F.col("event_id") % 7) / F.lit(10.0)).alias("flux_err"), F.get_json_object("props", "$.k").cast("long").alias("quality"), "event_id", "event_type")


#: The same in SQL, as the start of a WITH clause.
LC = """WITH lc AS (
  SELECT user_id AS series_id, epoch_us(ts) / 86400e6 AS t, value AS flux, 1 + (event_id % 7) / 10e0 AS flux_err,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS quality, event_id, event_type
  FROM events WHERE value IS NOT NULL AND ts IS NOT NULL
)"""


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """All doubles rounded."""
    return df.select(*(rounded(F.col(c), digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))
