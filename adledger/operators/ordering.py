"""Row selection that stays cheap: parsed once, and spread out when one group holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_rows(df: DataFrame, test: Column) -> DataFrame:
    """Rows that pass a test on a costly column, such as a parsed document.

    A plain filter would be pushed below the projection that makes the column, and the document parsed once
    for the test and again for its fields. A generator of one row or none keeps the work in one place.
    """
    return df.select("*", F.explode(F.when(test, F.array(F.lit(True)))).alias("_keep")).drop("_keep")


def first_rows(df: DataFrame, keys: list[str], order: list, limit: int = 1) -> DataFrame:
    """The first ``limit`` rows of each key.

    A row-number filter this small is pushed below the shuffle by the optimizer, so each task passes on at
    most ``limit`` rows per key and a hot key costs no more than a cold one.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")
