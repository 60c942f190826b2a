"""CSV, text and code files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.config import IGNORED_DIRECTORIES, SCAN_EXTENSIONS
from tracewell.schemas import RENAMED


def csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A CSV file of known columns; quoted fields may hold line breaks, and a byte-order mark is dropped."""
    df = spark.read.csv(path, schema=schema, header=header, multiLine=True, escape='"', enforceSchema=True)
    return df.withColumnsRenamed({c: RENAMED[c.lower()] for c in df.columns if c.lower() in RENAMED})


def names(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines, trimmed."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name != ''")


def decoded(content: Column) -> Column:
    """UTF-8, else ISO-8859-1, which never fails."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


def code_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = SCAN_EXTENSIONS, without_extension: bool = True, most_chars: int | None = 500_000, ignored_repos: tuple[str, ...] = ()) -> DataFrame:
    """path (below the root), repo_name, file_name, extension and content of the files of a tree, less ignored directories."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    below = F.regexp_replace("path", "^.*?" + "\\Q" + path.split("://")[-1].rstrip("/") + "\\E/", "")
    files = raw.withColumn("path", below).withColumn("_parts", F.split("path", "/"))
    folders = F.slice("_parts", 1, F.size("_parts") - 1)
    files = files.where(~F.exists(folders, lambda d: d.startswith(".") | d.isin(*IGNORED_DIRECTORIES)))
    name = F.element_at("_parts", -1)
    ending = F.when(name.contains("."), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))).otherwise("")
    files = files.withColumn("extension", ending).where(F.col("extension").isin(*extensions, *([""] if without_extension else [])))
    files = files.select("path", F.when(F.size("_parts") > 1, F.element_at("_parts", 1)).otherwise("unknown").alias("repo_name"), name.alias("file_name"), "extension", decoded(F.col("content")).alias("content"))
    if ignored_repos:
        files = files.where(~F.col("repo_name").isin(*ignored_repos))
    return files if most_chars is None else files.where(F.length("content") <= most_chars)


def workflow_repos(files: DataFrame, name_patterns: list[str], probe_files: list[str], code_patterns: list[str], probed: int = 50) -> DataFrame:
    """Repositories that a name pattern, a file of a telling name, or code in their first Python files marks as workflows."""
    by_name = files.select("repo_name").distinct().where(F.col("repo_name").rlike("(?i)" + "|".join(f"(?:{p})" for p in name_patterns)))
    by_file = files.where(F.lower("file_name").isin(*[p.lower() for p in probe_files])).select("repo_name")
    first = files.where("extension = 'py'").groupBy("repo_name").agg(F.sort_array(F.collect_set("path")).alias("paths")).select("repo_name", F.explode(F.slice("paths", 1, probed)).alias("path"))
    by_code = files.join(first, ["repo_name", "path"]).where(F.col("content").rlike("|".join(f"(?:{p})" for p in code_patterns))).select("repo_name")
    reason = lambda df, r: df.select("repo_name", F.lit(r).alias("reason"))
    return reason(by_name, "name").unionByName(reason(by_file, "file")).unionByName(reason(by_code, "code")).groupBy("repo_name").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def dashboard_dependents(dependents: DataFrame, details: DataFrame) -> DataFrame:
    """Tables with the dashboards that depend on them: (table_name, guid, object_type) and (guid, name, ...)."""
    from tracewell.functions.names import object_name

    boards = dependents.where(F.upper("object_type").isin("LIVEBOARD", "PINBOARD"))
    return boards.join(details, "guid", "left").select("table_name", object_name("name", "guid").alias("liveboard_name"), "guid").distinct()
