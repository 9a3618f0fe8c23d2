"""M9: the two starter models - drop NULL ids; keep id 1 of the first model's output.

Both run on a fixed two-row inline relation in the reference, so they are library
functions with a unit test, not registered queries (registered queries must read the
given tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inline_rows(spark: SparkSession) -> DataFrame:
    """``select 1 as id union all select null as id``."""
    return spark.createDataFrame([(1,), (None,)], "id int")


def rows_not_null(df: DataFrame) -> DataFrame:
    return df.filter(F.col("id").isNotNull())


def id_one(df: DataFrame) -> DataFrame:
    return df.filter(F.col("id") == 1)
