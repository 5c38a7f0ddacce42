"""The daily hour table kept up to date as files of sheet rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adledger import schemas
from adledger.operators.ads import hour_histogram
from adledger.sources.writers import write_hub_table

LANDED = f"site_id STRING, hub_partition_date DATE, {schemas.INPUTS['sheet_rows']}"


def hours_of(rows: DataFrame) -> DataFrame:
    """Hour table rows of landed sheet rows; site and day ride along in the scraper key."""
    keyed = rows.withColumn("scraper", F.struct("site_id", "hub_partition_date", "scraper"))
    counted = hour_histogram(keyed)
    return counted.select("scraper.*", "hour", "ads_count")


def start_hour_intake(spark: SparkSession, landing: str, root: str, checkpoint: str) -> StreamingQuery:
    """Recompute and replace the days that new files belong to, then stop when nothing new is left.

    A batch only names the days to redo; their rows are read from the landing folder in full. A batch that runs
    twice after a failure writes the same days with the same content.
    """

    def publish(batch: DataFrame, _batch_id: int) -> None:
        days = batch.select("hub_partition_date").distinct()
        landed = batch.sparkSession.read.schema(LANDED).parquet(landing)
        write_hub_table(hours_of(landed.join(days, "hub_partition_date", "left_semi")), root, "scraper_hourly_daily")

    arriving = spark.readStream.schema(LANDED).parquet(landing)
    return arriving.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# --- by increments: counts of each batch beside each other -----------------------------------------------

COUNTS = "site_id STRING, hub_partition_date DATE, scraper STRING, hour INT, ads_count BIGINT, late BOOLEAN, batch BIGINT"


def start_hour_counts(spark: SparkSession, landing: str, store: str, checkpoint: str, late_after: int = 7) -> StreamingQuery:
    """Count the rows of new files, and only of those, then stop when nothing new is left.

    Each batch stores its own counts under its number, so one that runs again after a failure replaces what it wrote.
    The newest day that earlier batches counted, less ``late_after`` days, is the watermark: rows of days before it are
    late. They are counted too, but apart from the others, since those days are closed.
    """

    def count(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = session.read.schema(COUNTS).parquet(store).filter(F.col("batch") < number) if number else session.createDataFrame([], COUNTS)
        newest = before.agg(F.max("hub_partition_date").alias("day")).first()["day"]
        late = F.col("hub_partition_date") < F.date_sub(F.lit(newest).cast("date"), late_after)
        counted = hours_of(batch).withColumn("late", F.coalesce(late, F.lit(False)))
        counted.coalesce(1).write.mode("overwrite").parquet(f"{store.rstrip('/')}/batch={number}")

    arriving = spark.readStream.schema(LANDED).parquet(landing)
    return arriving.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hour_counts(spark: SparkSession, store: str) -> DataFrame:
    """The hour table of all batches: ``ads_count``, and ``late_count`` of rows that came after their day was closed."""
    late, keys = F.col("late"), ["site_id", "hub_partition_date", "scraper", "hour"]
    none = F.lit(0).cast("bigint")
    return spark.read.schema(COUNTS).parquet(store).groupBy(*keys).agg(
        F.sum(F.when(~late, F.col("ads_count")).otherwise(none)).alias("ads_count"),
        F.sum(F.when(late, F.col("ads_count")).otherwise(none)).alias("late_count"),
    )
