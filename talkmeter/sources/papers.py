"""Paper feeds: Atom XML and JSONL files to an upserted papers table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmeter.functions.text import id_from_url
from talkmeter.operators.latest import first_by
from talkmeter.sources import keyed, tables

RECORD_SCHEMA = (
    "id string, title string, summary string, published string, "
    "authors array<string>, categories array<string>"
)
RECORD_FIELDS = ["id", "title", "summary", "published", "authors", "categories"]
PAPER_COLUMNS = [
    "paper_id", "arxiv_url", "title", "abstract", "authors", "categories",
    "published_date", "s3_key", "ingested_at",
]
PAPER_SCHEMA = (
    "paper_id string, arxiv_url string, title string, abstract string, "
    "authors array<string>, categories array<string>, published_date timestamp_ntz, "
    "s3_key string, ingested_at timestamp_ntz"
)
ENTRY_SCHEMA = (
    "id string, title string, summary string, published string, "
    "author array<struct<name:string>>, category array<struct<_term:string>>"
)


# --- Atom XML ----------------------------------------------------------------


def entry_records(entry: Column) -> list[Column]:
    """Record columns of a parsed ``<entry>``; a missing text is ``''``."""

    def trimmed(name: str) -> Column:
        return F.regexp_replace(F.coalesce(entry[name], F.lit("")), r"^\s+|\s+$", "").alias(name)

    def listed(items: Column, field: str) -> Column:
        values = F.transform(items, lambda item: item[field])
        return F.coalesce(values, F.array().cast("array<string>"))

    return [
        entry["id"].alias("id"),
        trimmed("title"),
        trimmed("summary"),
        entry["published"].alias("published"),
        listed(entry["author"], "name").alias("authors"),
        listed(entry["category"], "_term").alias("categories"),
    ]


def parse_entries(entries: DataFrame, column: str = "entry") -> DataFrame:
    """Records from a column that holds one ``<entry>`` element per row."""
    others = [name for name in entries.columns if name != column]
    parsed = F.from_xml(F.col(column), ENTRY_SCHEMA, {"rowTag": "entry", "ignoreSurroundingSpaces": "false"})
    return entries.select(*others, parsed.alias("parsed")).select(
        *others, *entry_records(F.col("parsed"))
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Records of Atom files; a file is split at its entries."""
    raw = (
        spark.read.format("xml")
        .schema(ENTRY_SCHEMA)
        .option("rowTag", "entry")
        .load(path)
    )
    whole = raw.select(F.struct("*").alias("parsed"))
    return whole.select(*entry_records(F.col("parsed")))


def union_topics(batches: list[DataFrame]) -> DataFrame:
    """Result sets of all topics, each tagged with its place in the list."""
    tagged = [batch.withColumn("topic", F.lit(place)) for place, batch in enumerate(batches)]
    return reduce(DataFrame.unionByName, tagged)


def keep_first(records: DataFrame, order: list[str]) -> DataFrame:
    """First arrival per id; plain ``dropDuplicates`` would pick any."""
    return first_by(records, ["id"], [F.col(name).asc_nulls_last() for name in order])


# --- JSONL ---------------------------------------------------------------------


def new_files(files: DataFrame, marker: str | Column | None, key: str = "s3_key") -> DataFrame:
    """Keys ending in ``.jsonl`` that sort strictly after the marker, in order."""
    wanted = files.filter(F.col(key).endswith(".jsonl")).select(key).distinct()
    if marker is not None:
        wanted = wanted.filter(F.col(key) > marker)
    return wanted.orderBy(key)


def read_lines(
    spark: SparkSession, paths: str | list[str], marker: str | None = None
) -> DataFrame:
    """Text lines with their file and a position that follows file order.

    A file may be read as several splits; inside one the row counter ascends,
    so (file, split offset, counter) is the order of the lines. The marker
    filters on file metadata, which drops old files before they are opened.
    """
    text = spark.read.option("pathGlobFilter", "*.jsonl").text(paths)
    if marker is not None:
        text = text.filter(F.col("_metadata.file_name") > marker)
    return text.select(
        "value",
        F.col("_metadata.file_name").alias("s3_key"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("line"),
    )


LINE_ORDER = ["s3_key", "split_start", "line"]


def decode_lines(lines: DataFrame) -> DataFrame:
    """Each non-blank line with its record and the reason it is bad, if any."""
    record = F.from_json(
        "value",
        f"{RECORD_SCHEMA}, _broken string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"},
    )
    decoded = lines.filter(F.trim("value") != "").withColumn("record", record)
    missing = reduce(
        lambda left, right: left | right,
        [F.col(f"record.{name}").isNull() for name in RECORD_FIELDS],
    )
    published = F.col("record.published").try_cast("timestamp_ntz")
    problem = (
        F.when(F.col("record._broken").isNotNull(), "broken json")
        .when(missing, "missing field")
        .when(published.isNull(), "bad date")
    )
    return decoded.withColumn("problem", problem)


def papers_from(decoded: DataFrame, ingested_at: str | Column) -> DataFrame:
    """Paper rows of the good lines; order columns stay for the upsert."""
    moment = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    record = {name: F.col(f"record.{name}") for name in RECORD_FIELDS}
    order = [name for name in ("split_start", "line") if name in decoded.columns]
    return decoded.filter(F.col("problem").isNull()).select(
        id_from_url(record["id"]).alias("paper_id"),
        record["id"].alias("arxiv_url"),
        record["title"].alias("title"),
        record["summary"].alias("abstract"),
        record["authors"].alias("authors"),
        record["categories"].alias("categories"),
        record["published"].cast("timestamp_ntz").alias("published_date"),
        "s3_key",
        moment.cast("timestamp_ntz").alias("ingested_at"),
        *order,
    )


def parse_lines(lines: DataFrame, ingested_at: str | Column) -> DataFrame:
    return papers_from(decode_lines(lines), ingested_at)


def next_file_marker(
    files: DataFrame, papers: DataFrame, marker: str | None, key: str = "s3_key"
) -> DataFrame:
    """Greatest key of the batch, but only if some paper was parsed."""
    old = F.lit(marker).cast("string")
    any_paper = papers.limit(1).agg(F.count("*") > 0).scalar()
    return files.agg(
        F.when(any_paper, F.coalesce(F.max(key), old)).otherwise(old).alias("marker")
    )


def line_counts() -> list[Column]:
    problem = F.col("problem")
    return [
        F.count_if(problem.isNull()).alias("rows_loaded"),
        F.count_if(problem == "broken json").alias("broken_json"),
        F.count_if(problem == "missing field").alias("missing_field"),
        F.count_if(problem == "bad date").alias("bad_date"),
    ]


def file_summary(decoded: DataFrame) -> DataFrame:
    """The files of a load with their rows loaded and lines skipped by reason."""
    return decoded.groupBy("s3_key").agg(*line_counts())


def load_summary(decoded: DataFrame, files: DataFrame, run_at: str | Column) -> DataFrame:
    """One row per load: file count, rows loaded, lines skipped by reason.

    The file list itself is a table (``file_summary``), not one growing value.
    """
    moment = F.lit(run_at) if isinstance(run_at, str) else run_at
    return decoded.agg(*line_counts()).select(
        moment.cast("timestamp_ntz").alias("run_at"),
        files.agg(F.count("*")).scalar().alias("files_processed"),
        "*",
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the files in a folder; their content is not read."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("s3_key"))


def merge_papers(papers: DataFrame, path: str, buckets: int = 64) -> list[int]:
    """Upsert parsed papers into the table; of one paper the last line in file order stays."""
    order = [F.desc_nulls_last(name) for name in LINE_ORDER if name in papers.columns]
    return keyed.merge(papers, path, PAPER_SCHEMA, ["paper_id"], order, buckets)


def current_papers(spark: SparkSession, path: str) -> DataFrame:
    return keyed.read(spark, path, PAPER_SCHEMA)


def load_new_files(
    spark: SparkSession, folder: str, base: str, ingested_at: str, name: str = "papers"
) -> DataFrame:
    """Load the files after the marker into the papers table; returns the summary.

    Papers are merged before the marker moves, and only if some paper was
    parsed. Dying in between repeats the files, which changes nothing.
    """
    step, marker = tables.read_step(spark, f"{base}/_marks", name, None)
    files = new_files(list_files(spark, folder), marker)
    lines = read_lines(spark, folder, marker).join(files, "s3_key", "left_semi")
    decoded = decode_lines(lines)
    summary = load_summary(decoded, files, ingested_at)
    loaded = papers_from(decoded, ingested_at)
    reached = next_file_marker(files, loaded, marker).first()["marker"]
    if reached != marker:
        merge_papers(loaded, f"{base}/papers")
        tables.write_mark(spark, f"{base}/_marks", name, reached, after=step)
    return summary
