"""Sources (S1-S5, S9-S12)."""

from __future__ import annotations

from fnmatch import translate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger import schemas
from adledger.functions import variants as V
from adledger.operators.layout import PARTITION, partition_prefixes
from adledger.session import task_count
from adledger.sources.versions import published, read_published, version_path, versions

DAY_FOLDER = r"/(\d{4}-\d{2}-\d{2})/[^/]*$"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, asked of the file system the path belongs to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def source_path() -> Column:
    """Path of the file a row came from, blanks decoded."""
    return F.replace(F.col("_metadata.file_path"), F.lit("%20"), F.lit(" "))


#: JSON files however the ending is written.
JSON_FILES = "*.[jJ][sS][oO][nN]"

#: Ending of files that hold the documents of their folder as lines.
LINES_ENDING = ".documents.jsonl.gz"


def date_folder(path: Column) -> Column:
    """Save date from the year, month and day folders of a path, padded or not."""
    part = lambda n: F.regexp_extract(path, PARTITION, n)
    return F.concat_ws("-", part(2), F.lpad(part(3), 2, "0"), F.lpad(part(4), 2, "0")).try_cast("date")


def folders_there_are(spark: SparkSession, patterns: list[str]) -> list[str]:
    """The folders that match any of the patterns. Only the folders on the way to a match are listed."""
    found: set[str] = set()
    for pattern in patterns:
        target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        statuses = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
        found.update(s.getPath().toString() for s in statuses or [])
    return sorted(found)


def day_folders(spark: SparkSession, root: str, dates: list[str], bases: tuple[str, ...]) -> list[str]:
    """The padded and unpadded folders (L2) of the asked days that exist below ``root``, in any of ``bases``.

    A base is the folder that holds the year folders, a pattern such as ``*``, or empty for ``root`` itself. A year of
    other days is never listed.
    """
    asked = spark.createDataFrame([("/".join(x for x in (root.rstrip("/"), base) if x), str(d)) for base in bases for d in dates], "base string, date string")
    return folders_there_are(spark, [r["prefix"] for r in partition_prefixes(asked).select("prefix").collect()])


def dated_folders(spark: SparkSession, root: str, dates: list[str], bases: tuple[str, ...]) -> list[str]:
    """Folders named by one of the dates, in any of ``bases`` below ``root``."""
    return folders_there_are(spark, ["/".join(x for x in (root.rstrip("/"), base, str(d)) if x) for base in bases for d in dates])


def whole_documents(spark: SparkSession, paths: str | list[str], glob: str = JSON_FILES, lines: bool = False) -> DataFrame:
    """Every matching file under the paths as one ``(key, body)`` row; no paths give no rows.

    With ``lines`` documents that were written as lines count as well, each as if it were a file of its name.

    Files are read as bytes, which needs no settings of its own for each file as whole texts do. Spark counts a file as
    4 MB when it packs files into tasks, so small documents would make a task, and later an output file, of every 32;
    they are put together to no more tasks than a shuffle has, without one.
    """
    if not paths:
        return spark.createDataFrame([], "key string, body string")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    rows = reader.load(paths).select(source_path().alias("key"), F.col("content").cast("string").alias("body"))
    files = rows.coalesce(task_count(spark))
    return files.unionByName(_documents_of_lines(spark, paths, glob)) if lines else files


def _documents_of_lines(spark: SparkSession, paths: str | list[str], glob: str) -> DataFrame:
    """Documents written as lines whose names match. As of files, names that begin with a dot or an underscore do not count."""
    reader = spark.read.schema("name string, body string").option("mode", "FAILFAST").option("recursiveFileLookup", True)
    rows = reader.option("pathGlobFilter", f"*{LINES_ENDING}").json(paths)
    named = F.col("name").rlike(translate(glob)) & ~F.col("name").rlike("^[._]")
    return rows.filter(named).select(F.concat(F.regexp_extract(source_path(), "^(.*/)", 1), "name").alias("key"), "body")


def read_listing_json(
    spark: SparkSession, root: str, dates: list[str] | None = None, lines: bool = False, bases: tuple[str, ...] = ("", "*")
) -> DataFrame:
    """Listings of the per-category JSON of the given days, all days when none is given.

    A file is one JSON array named by its category, or ``<category>.part-<k>.json`` where it is one of several. With
    ``lines`` it holds one listing per line, which Spark can split, and the category comes from a ``category=`` folder.
    Of asked days only their own folders are listed and read, those under ``bases`` (see ``day_folders``); days
    without a folder are passed over.
    """
    schema = schemas.INPUTS["listings"]
    paths = day_folders(spark, root, dates, bases) if dates else [root]
    if not paths:
        return spark.createDataFrame([], f"category STRING, save_date DATE, {schema}")
    reader = spark.read.schema(schema).option("multiLine", not lines).option("recursiveFileLookup", True)
    rows = reader.option("pathGlobFilter", JSON_FILES).json(paths)
    path = source_path()
    category = F.regexp_extract(path, r"category=([^/]+)/" if lines else r"(?i)([^/]+?)(?:\.part-\d+)?\.json$", 1)
    return rows.select(category.alias("category"), date_folder(path).alias("save_date"), "*")


def read_brand_json(spark: SparkSession, root: str) -> DataFrame:
    """S1, second form: brand documents with types and their details."""
    details = f"array<struct<{', '.join(c.replace(' ', ':', 1) for c in schemas.INPUTS['listings'].split(', '))}>>"
    schema = f"brand STRING, types ARRAY<STRUCT<type:STRING,details:{details}>>"
    reader = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
    brands = reader.option("pathGlobFilter", JSON_FILES).json(root).select("brand", F.explode("types").alias("t"))
    return brands.select("brand", F.col("t.type").alias("type"), F.explode("t.details").alias("d")).select("brand", "type", "d.*")


def read_summary_json(
    spark: SparkSession, root: str, for_metrics: bool = False, dates: list[str] | None = None, bases: tuple[str, ...] = ("", "*", "*/*"), lines: bool = False
) -> DataFrame:
    """Candidate summaries ``(key, prefix_form, body)``; text that is no JSON is dropped. Days prune folders as in S1.

    ``json-files/`` folders always count. For request metrics a file in the date folder itself also counts when
    its name speaks of a summary; those come after the others. With ``lines`` also documents that were written as lines
    count, by the same rules.
    """
    docs = whole_documents(spark, day_folders(spark, root, dates, bases) if dates else root, lines=lines)
    name = F.lower(F.regexp_extract("key", r"([^/]*)$", 1))
    in_folder = F.col("key").contains("/json-files/")
    at_root = F.col("key").rlike(r"/day=\d{1,2}/[^/]*$") & name.contains("summary")
    kept = docs.filter(in_folder | at_root) if for_metrics else docs.filter(in_folder)
    return kept.filter(V.parse("body").isNotNull()).select(
        "key", F.when(in_folder, 0).otherwise(1).alias("prefix_form"), "body"
    )


def read_reports(spark: SparkSession, root: str, dates: list[str] | None = None, sites: tuple[str, ...] = ("*", "*/*")) -> DataFrame:
    """S3: one report per site and day ``(prefix, report_date, doc)`` of the given dates, all when none is given.

    Of asked dates only their folders are listed and read: ``<site>/monitor/<date>`` for the ``sites`` below ``root``,
    which may be patterns.
    """
    bases = tuple(f"{site}/monitor" for site in sites)
    docs = whole_documents(spark, dated_folders(spark, root, dates, bases) if dates else root, "report.json")
    return docs.select(
        F.regexp_extract("key", r"([^/]+)/monitor/[^/]+/[^/]*$", 1).alias("prefix"),
        F.regexp_extract("key", DAY_FOLDER, 1).try_cast("date").alias("report_date"),
        V.parse("body").alias("doc"),
    ).filter(F.col("doc").isNotNull())


def read_hub_document(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """Merged documents ``(hub_date, doc)`` of the given dates, whose folders alone are read; all when none is given."""
    docs = whole_documents(spark, dated_folders(spark, root, dates, ("", "*")) if dates else root, "all-sites.json")
    return docs.select(
        F.regexp_extract("key", DAY_FOLDER, 1).try_cast("date").alias("hub_date"), V.parse("body").alias("doc")
    ).filter(F.col("doc").isNotNull())


def read_hub_table(spark: SparkSession, root: str, table: str, date: str | None = None) -> DataFrame:
    """One daily table; an absent table is empty with its full schema. The date filter prunes folders.

    Where days were published in batches, only those that are switched on are seen.
    """
    if published(spark, root):
        return read_published(spark, root, table, date)
    path, schema = f"{root.rstrip('/')}/{table}", schemas.table_schema(table)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path).select(*schemas.table_columns(table))
    return rows.filter(F.col("hub_partition_date") == F.lit(date).cast("date")) if date else rows


def read_sheet_rows(spark: SparkSession, root: str, kind: str = "parquet") -> DataFrame:
    """Normalized sheet rows. In CSV and JSON lines the cells are a JSON object in the text column ``cells``."""
    if kind == "parquet":
        return spark.read.schema(schemas.INPUTS["sheet_rows"]).parquet(root)
    if kind not in ("csv", "json"):
        raise ValueError(f"unknown sheet row format: {kind}")
    flat = schemas.INPUTS["sheet_rows"].replace("MAP<STRING,STRING>", "STRING")
    reader = spark.read.schema(flat)
    rows = reader.option("header", True).option("escape", '"').csv(root) if kind == "csv" else reader.json(root)
    return rows.withColumn("cells", F.from_json("cells", "map<string,string>"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The site registry, one row per site with its place in the list."""
    schema = f"sites ARRAY<STRUCT<{', '.join(c.replace(' ', ':', 1) for c in schemas.INPUTS['registry_site'].split(', '))}>>"
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    return doc.select(F.posexplode("sites").alias("seq", "s")).select("seq", "s.*")


def read_expectations(spark: SparkSession, path: str) -> DataFrame:
    """The expected sheets of every scraper."""
    sheet = ", ".join(c.replace(" ", ":", 1) for c in schemas.INPUTS["expected_sheet"].split(", "))
    schema = f"excel_schema ARRAY<STRUCT<scraper:STRING, min_file_size_kb:DOUBLE, sheets:ARRAY<STRUCT<{sheet}>>>>"
    entries = spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline("excel_schema"))
    rows = entries.select("scraper", "min_file_size_kb", F.inline("sheets"))
    bound = lambda i, default: F.coalesce(F.try_element_at("row_count_range", F.lit(i)), F.lit(default)).cast("bigint")
    return rows.select(
        "scraper", "min_file_size_kb", "name", "required_columns", "optional_columns",
        bound(1, 0).alias("row_min"), bound(2, 999999).alias("row_max"),
    )


def read_baseline(spark: SparkSession, path: str, kind: str = "baseline") -> DataFrame:
    """Stored statistics, the newest version of them; an absent store is an empty start.

    A store written before versions were kept is read as it is.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.INPUTS[kind])
    numbers = versions(spark, path)
    return spark.read.schema(schemas.INPUTS[kind]).parquet(version_path(path, numbers[-1]) if numbers else path)


def read_category_list(spark: SparkSession, path: str) -> DataFrame:
    """A fixed list of categories."""
    return spark.read.schema(schemas.INPUTS["category"]).option("multiLine", True).json(path)
