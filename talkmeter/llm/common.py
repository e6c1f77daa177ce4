"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkmeter.session import new_run_folder

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROW = "__row"  # the whole input row, so that its other columns can't clash with ours


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows as written files in the shared folder: lineage ends there."""
    path = new_run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame) -> Column:
    """The text, a null as an empty one."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def packed(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def wide_hash(column: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: together wide enough to stand for the value."""
    return F.xxhash64(column), F.xxhash64(F.lit("second"), column)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_totals(
    df: DataFrame, order: list[Column], sums: dict[str, Column], label: str
) -> DataFrame:
    """The rows with the totals of ``sums`` over all rows before them in ``order``.

    Rows are dealt by range and written, so that a row's part is settled; totals run inside each
    part, and over the parts, of which there is one per task.
    """
    dealt = staged(
        df.repartitionByRange(tasks(df.sparkSession), *order)
        .withColumn("__part", F.spark_partition_id()),
        label,
    )
    parts = dealt.groupBy("__part").agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(
        parts.select(
            F.col("__part").alias("__its_part"),
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__{n}") for n in sums],
        ),
        f"{label}-bases",
    )
    before = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = {n: F.coalesce(F.sum(c).over(before), F.lit(0)) + F.col(f"__{n}") for n, c in sums.items()}
    joined = dealt.join(bases, F.col("__part") == F.col("__its_part"))
    return joined.withColumns(own).drop("__part", "__its_part", *[f"__{n}" for n in sums])
