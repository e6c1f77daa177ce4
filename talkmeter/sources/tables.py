"""Tables on shared storage: ledgers, marks, published versions, seeds.

Nothing is overwritten in place. Ledgers and marks only grow; a rewritten table
goes to a new version folder and becomes visible through an appended pointer,
so a lost executor or a killed driver leaves the previous version readable.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from talkmeter import vocabulary as V
from talkmeter.sources import files

LABEL_SCHEMA = ", ".join(
    [
        "conversation_id bigint",
        "expected_outcome string",
        *[f"expected_{name} int" for name in V.RUBRIC],
        "labeler string",
        "labeled_at date",
        "label_cohort string",
        "is_blind boolean",
        "difficulty string",
    ]
)

LOAD = "_load"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_BUCKETS = 4


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The Parquet table at ``path``, or an empty one before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# --- marks -----------------------------------------------------------------


class Moved(RuntimeError):
    """Raised when another writer moved a mark first; nothing of it was overwritten."""


def read_step(
    spark: SparkSession, path: str, name: str, default: str | None
) -> tuple[int, str | None]:
    """The mark and the number of the step that set it (0 before the first).

    Steps are files 1, 2, 3 ...; the last one is found by doubling and halving.
    """
    def there(step: int) -> bool:
        return files.exists(spark, f"{path}/{name}/{step}")

    low, high = 0, 1
    while there(high):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if there(middle) else (low, middle)
    return (low, files.read_text(spark, f"{path}/{name}/{low}")) if low else (0, default)


def read_mark(spark: SparkSession, path: str, name: str, default: str | None) -> str | None:
    return read_step(spark, path, name, default)[1]


def write_mark(
    spark: SparkSession, path: str, name: str, mark: str, after: int | None = None
) -> int:
    """Set the mark as the step that follows ``after`` (default: the latest one).

    Every step is a file of its own that only one writer can create: if another
    has taken the step already, the mark stays and ``Moved`` is raised.
    """
    step = (read_step(spark, path, name, None)[0] if after is None else after) + 1
    if not files.create_once(spark, f"{path}/{name}/{step}", mark):
        raise Moved(f"{path}: step {step} of {name} was taken by another writer")
    return step


def take_number(spark: SparkSession, path: str, name: str) -> int:
    """A number that no other caller got, greater than all taken before."""
    while True:
        try:
            return write_mark(spark, path, name, "taken")
        except Moved:
            continue


# --- published versions --------------------------------------------------------


def publish(
    df: DataFrame, base: str, partition_by: list[str] | None = None, after: int | None = None,
    bucket_by: str | None = None, buckets: int = 0,
) -> int:
    """Write a version of a table and point readers at it; returns the pointer's step.

    The version goes to a folder of its own. ``after`` is the step that the new
    version was made from: if the pointer has moved since, ``Moved`` is raised
    and readers keep what they have. Tables with one row per conversation may be
    bucketed by it, so that joins between them need no shuffle and a search by id opens
    its buckets only (sorted, and with a bloom filter of the ids). Messages must not:
    a conversation with a third of all messages would make one bucket a third of the table.
    """
    spark = df.sparkSession
    if after is None:
        after = read_step(spark, f"{base}/_pointer", "version", None)[0]
    folder = f"version={after + 1}-{uuid.uuid4().hex}"
    place = f"{base}/{folder}"
    if bucket_by:
        # One task writes one bucket, so a bucket is one sorted file. Rows that a join has dealt and sorted by the
        # key already go straight to it: a writer per bucket asks for no order, where ``sortBy`` would sort anew.
        sorted_rows = df.repartition(buckets, bucket_by).sortWithinPartitions(bucket_by)
        before = spark.conf.get(WRITERS)
        spark.conf.set(WRITERS, OPEN_BUCKETS)
        try:
            sorted_rows.write.mode("errorifexists").bucketBy(buckets, bucket_by).option(
                f"parquet.bloom.filter.enabled#{bucket_by}", "true"
            ).option("path", place).saveAsTable(table_name(folder))
        finally:
            spark.conf.set(WRITERS, before)
        folder = f"{folder}|{bucket_by}|{buckets}"
    else:
        df.write.mode("errorifexists").partitionBy(*(partition_by or [])).parquet(place)
    return write_mark(spark, f"{base}/_pointer", "version", folder, after)


def table_name(folder: str) -> str:
    return f"published_{folder.rsplit('-', 1)[1]}"


def opened(spark: SparkSession, base: str, mark: str, schema: str | StructType) -> DataFrame:
    """A published version; bucketed ones are made known to the session's catalogue."""
    folder, *bucketed = mark.split("|")
    if not bucketed:
        return spark.read.schema(schema).parquet(f"{base}/{folder}")
    name, (key, buckets) = table_name(folder), bucketed
    if not spark.catalog.tableExists(name):
        fields = schema if isinstance(schema, str) else ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
        )
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
            f"INTO {buckets} BUCKETS LOCATION '{base}/{folder}'"
        )
    return spark.table(name)


def current_step(spark: SparkSession, base: str, schema: str | StructType) -> tuple[int, DataFrame]:
    """The version readers are pointed at, and its step; empty before the first publish."""
    step, mark = read_step(spark, f"{base}/_pointer", "version", None)
    return (0, spark.createDataFrame([], schema)) if mark is None else (step, opened(spark, base, mark, schema))


def current(spark: SparkSession, base: str, schema: str | StructType) -> DataFrame:
    return current_step(spark, base, schema)[1]


# --- ledgers ----------------------------------------------------------------------


def append_ledger(
    rows: DataFrame, path: str, by_version: bool = True, load: int | None = None
) -> None:
    """Append ledger rows; the version partition lets queue reads prune, that of the load those of folds."""
    parts = ["prompt_version"] if by_version else []
    if load is not None:
        rows, parts = rows.withColumn(LOAD, F.lit(load).cast("long")), [LOAD, *parts]
    rows.write.mode("append").partitionBy(*parts).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The whole ledger; columns added later are NULL on older rows. Numbers of loads stay behind."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop(LOAD)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows under the union of both column sets."""
    return old.unionByName(new, allowMissingColumns=True)


# --- seeds and JSON copies -----------------------------------------------------------


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Human labels from CSV; empty cells are NULL."""
    return spark.read.schema(LABEL_SCHEMA).option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
