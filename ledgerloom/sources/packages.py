"""Source packages: folders of manifests, clean text, recovered tables and figures.

A package is ``<root>/<name>/`` with ``source_package_manifest.json``,
``audit/source_fidelity.json``, ``docling/document.clean.md`` and, for each item,
``tables/<id>/table.records.json`` (or ``.recovered.json``, ``.md``) and
``figures/<id>/figure.recovered.json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def package_of(path: Column, root: str) -> Column:
    """The package's name in a file's path."""
    return F.regexp_extract(path, f"\\Q{root.rstrip('/')}\\E/([^/]+)/", 1)


def scan_files(spark: SparkSession, root: str, pattern: str, first: int | None = None) -> DataFrame:
    """Files by pattern at any depth (S1) with their hash (S2), in the order of their path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    found = files.select("path", "length", F.sha2("content", 256).alias("sha256")).orderBy("path")
    return found.limit(first) if first is not None else found


def read_texts(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``(package, path, text)`` of whole text files."""
    texts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root, wholetext=True)
    path = F.input_file_name()
    return texts.select(package_of(path, root).alias("package"), path.alias("path"), F.col("value").alias("text"))


def read_packages(spark: SparkSession, root: str) -> DataFrame:
    """One row a package (S5); ``problem`` names what is missing or empty instead of failing
    the job for all others."""
    manifest = read_texts(spark, root, "source_package_manifest.json").select("package", F.get_json_object("text", "$.core_exports.clean_markdown").alias("clean_path"))
    fidelity = read_texts(spark, root, "source_fidelity.json").select(
        "package",
        F.get_json_object("text", "$.document.filename").alias("source_filename"),
        F.get_json_object("text", "$.document.sha256").alias("source_sha256"),
        F.get_json_object("text", "$.summary.overall_status").alias("initial_status"),
        F.get_json_object("text", "$.recovery_queue").alias("queue"),
    )
    clean = read_texts(spark, root, "document.clean.md").select("package", F.col("text").alias("clean_markdown"))
    rows = manifest.join(fidelity, "package", "full").join(clean, "package", "full")
    problem = F.when(F.col("clean_path").isNull(), "manifest").when(F.col("initial_status").isNull(), "source_fidelity").when(F.coalesce(F.trim("clean_markdown"), F.lit("")) == "", "clean_markdown")
    return rows.withColumn("problem", problem)


def table_records(spark: SparkSession, root: str) -> DataFrame:
    """Cells of ``table.records.json`` (S6) in their authored order.

    ``(package, table_id, row_index, col_ordinal, column, value)``; files that hold no list
    and rows that are no objects are skipped.
    """
    texts = read_texts(spark, root, "table.records.json").withColumn("table_id", F.regexp_extract("path", "/tables/([^/]+)/", 1))
    listed = texts.select("package", "table_id", F.from_json("text", "array<string>").alias("records")).where("records is not null")
    records = listed.select("package", "table_id", F.posexplode("records").alias("row_index", "record")).where(F.trim("record").startswith("{"))
    cells = records.select("package", "table_id", "row_index", F.posexplode(F.map_entries(F.from_json("record", "map<string,string>"))).alias("col_ordinal", "cell"))
    return cells.select("package", "table_id", "row_index", "col_ordinal", F.col("cell.key").alias("column"), F.col("cell.value").alias("value"))


def best_representation(items: DataFrame) -> DataFrame:
    """The best text of each item (S7): recovered, else records, else Markdown, else a note.

    ``items`` has (package, item_id, kind, text); a kind missing for an item is skipped.
    """
    rank = F.when(F.col("kind") == "recovered", 0).when(F.col("kind") == "records", 1).when(F.col("kind") == "markdown", 2)
    best = F.min(F.when(F.trim("text") != "", F.struct(rank.alias("r"), F.col("kind").alias("kind"), F.col("text").alias("text"))))
    return items.groupBy("package", "item_id").agg(best.alias("b")).select("package", "item_id", F.coalesce("b.kind", F.lit("placeholder")).alias("kind"), F.coalesce("b.text", F.lit("[not recovered]")).alias("text"))


def unresolved_items(spark: SparkSession, packages: DataFrame, root: str) -> DataFrame:
    """Queue items that ask for recovery and have no recovered artifact (F2)."""
    queue = packages.select("package", F.explode(F.from_json("queue", "array<struct<item_type:string,item_id:string,matched_picture_id:string,status:string,priority:string>>")).alias("q")).select("package", "q.*")
    asked = queue.where(F.col("status").isin("required", "recommended", "review")).withColumn("at", F.coalesce("matched_picture_id", "item_id"))
    done = read_texts(spark, root, "*.recovered.json").select("package", F.regexp_extract("path", "/(?:tables|figures|formulas)/([^/]+)/", 1).alias("at")).distinct()
    return asked.join(done, ["package", "at"], "left_anti").drop("at")
