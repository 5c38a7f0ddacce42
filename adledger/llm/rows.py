"""Shared steps of the corpus operators: whole texts as bytes, batches in tasks, decisions put into effect."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.session import saved, scratch_dir

#: Rows that a Python task turns into Python objects at once. Only memory depends on it.
ROWS_AT_ONCE = 256


def whole_text(df: DataFrame, text_col: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def bodies(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``body``: the whole text as UTF-8 bytes. All other columns stay behind."""
    return df.select(df[id_col].cast("long").alias("doc_id"), whole_text(df, text_col).cast("binary").alias("body"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Arrow batches in smaller parts, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def dealt(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """``df`` in as many partitions as ``rows``, a count that was taken, asks for, or as many as it has if those are fewer.

    Steps over few rows then run in few tasks and leave few files, and steps over many in many.
    """
    return df.coalesce(max(1, -(-rows // per_task)))


class Scratch:
    """Written tables that an operator itself supersedes: each is removed when what was made of it has been written."""

    def __init__(self) -> None:
        self.held: list[tuple[DataFrame, str]] = []

    def saved(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(df.sparkSession, label)
        df.write.parquet(path)
        table = df.sparkSession.read.schema(df.schema).parquet(path)
        self.held.append((table, path))
        return table

    def remove(self, *tables: DataFrame) -> None:
        """Removes the given tables, all that are held if none is given."""
        gone = [(t, p) for t, p in self.held if not tables or any(t is x for x in tables)]
        self.held = [h for h in self.held if not any(h[0] is t for t, _ in gone)]
        for table, path in gone:
            spark = table.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Buckets of a sieve, a power of two; each has 64 bits. So a sieve never has more rows than this, whatever the keys.
SIEVE = 1 << 18


def sieve(keys: DataFrame, key: str, scratch: Scratch | None = None) -> DataFrame:
    """A bitmap of the hashes of ``key``, as ``bucket`` and ``bits``: at most ``SIEVE`` rows, a few MB."""
    h = keys.select(F.xxhash64(key).alias("h"))
    bit = F.expr("shiftleft(1L, cast(shiftright(h, 18) & 63 AS int))")
    bits = h.groupBy(F.col("h").bitwiseAND(SIEVE - 1).alias("bucket")).agg(F.bit_or(bit).alias("bits"))
    return (scratch.saved if scratch else saved)(bits, "sieve")


def sifted(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """``df`` with ``may``: false if ``key`` is certainly none of the keys that ``bits`` was made of.

    Rows that cannot match are told apart where they stand; the others go on to an exact join. With far more keys than
    bits, all rows go on: the sieve has one size and saves less, but nothing depends on it.
    """
    hashed = df.withColumn("h_", F.xxhash64(key)).withColumn("bucket", F.col("h_").bitwiseAND(SIEVE - 1))
    met = hashed.join(F.broadcast(bits), "bucket", "left")
    return met.withColumn("may", F.expr("coalesce(getbit(bits, cast(shiftright(h_, 18) & 63 AS int)), 0) = 1")).drop("h_", "bucket", "bits")


def keep_decided(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, text_sha256, kept; a row per row of docs) keeps.

    All columns of ``docs`` come back and no others, whatever their names. Rows are told apart by id and text. Rows whose
    id a sieve of the dropped ids lets pass are joined exactly with the dropped keys; the others stay where they are. Of rows
    that repeat both id and text, as many stay as were kept; keys of such rows are next to none.
    """
    per_row = decided.groupBy("doc_id", "text_sha256").agg(
        F.count("*").alias("rows"), F.sum(F.col("kept").cast("long")).alias("stay"),
    )
    keys = saved(per_row.filter("stay < rows").select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha"), "stay"), "decided")
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")
    rows = sifted(docs.select(row, docs[id_col].cast("long").alias("id"), whole_text(docs, text_col).alias("whole")), "id", sieve(keys, "k_id"))
    asked = rows.filter("may").select("row", "id", F.sha2(F.col("whole").cast("binary"), 256).alias("sha"))
    same = F.col("id").eqNullSafe(F.col("k_id")) & (F.col("sha") == F.col("k_sha"))
    partly = asked.join(saved(keys.filter("stay > 0"), "partly-kept"), same).dropDuplicates(["k_id", "k_sha"])
    again = partly.select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("stay"))), "row")
    kept = rows.filter("NOT may").select("row").union(asked.join(keys, same, "left_anti").select("row")).union(again.select("row"))
    return kept.select("row.*")
