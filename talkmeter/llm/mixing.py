"""Mixing sources to target weights.

Tokens are summed per source; targets are the sources' weighted share of the wanted total, each
stopped at ``most`` times its source's size (water filling: the level is found from running sums
over the sources by size per weight); a document is repeated floor(rate) times, plus once more when
a hash of its id falls below the rate's fraction. Every source takes, of ``seeds`` seeds for that hash,
the one whose copies bring it nearest to its target: the sums for all seeds come from one pass, and
few or uneven documents then miss the target by less.

Defined results: a null text has size 0; a null source is a source, ordered last; sources of size 0
get target 0; documents of size 0 get one copy of rate 0 (taken 0); repeated rows are decided alike,
because the hash sees only id and source; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter.llm.common import ROW, packed, running_totals, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, share: float, most: float, weights: Sequence[float]
) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source.

    With sources ordered by most * size / weight, those up to some place are stopped and the rest
    stand at one level per weight. The first level that doesn't stop its own source is the answer;
    later ones count too much as stopped and lie lower, so it is the greatest of that kind.
    """
    by_name = [F.col("source").isNull(), F.col("source")]
    placed = running_totals(sizes, by_name, {"place": F.lit(1)}, "source-places")
    choice = F.array(*[F.lit(float(w)) for w in weights])
    full, weight = F.col("full"), F.col("weight")
    weighted = placed.select(
        "source", "source_size", (F.col("source_size") * F.lit(float(most))).alias("full"),
        F.element_at(choice, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
    )
    total = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    if total[0] is None:
        return weighted.select("source", "source_size", full.alias("target"))
    levels = running_totals(
        weighted, [full / weight, *by_name], {"stopped": full, "taken": weight}, "source-levels"
    )
    level = (F.lit(total[0]) * F.lit(float(share)) - F.col("stopped")) / (
        F.lit(total[1]) - F.col("taken")
    )
    highest = levels.agg(F.max(F.when(level * weight <= full, level))).first()[0]
    target = full if highest is None else F.least(full, F.lit(highest) * weight)
    return weighted.select("source", "source_size", target.alias("target"))


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) from a hash of the columns, the same in every run."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(16**12)


def rate_parts() -> tuple[Column, Column]:
    """The whole copies and the fraction of a further one, from target and source_size."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return F.floor(rate), rate - F.floor(rate)


def best_seeds(sized: DataFrame, targets: DataFrame, seed: str, seeds: int) -> DataFrame:
    """``targets`` with the seed number that serves each source best."""
    whole, fraction = rate_parts()
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("its_source")))
    sums = [
        F.sum(F.when(
            uniform(F.lit(seed), F.lit(k), F.col("doc_id"), F.col("source")) < F.col("fraction"),
            F.col("size"),
        ).otherwise(0)).alias(f"sum_{k}")
        for k in range(seeds)
    ]
    tried = (
        rows.withColumn("whole", whole).withColumn("fraction", fraction)
        .groupBy("its_source", "source_size", "target").agg(F.first("whole").alias("whole"), *sums)
    )
    missing = F.col("target") - F.col("whole") * F.col("source_size")
    off = [F.struct(F.abs(F.col(f"sum_{k}") - missing), F.lit(k).alias("k")) for k in range(seeds)]
    best = F.array_min(F.array(*off))["k"]
    return tried.select("its_source", "source_size", "target", best.alias("seed_number"))


def mixed(
    docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS,
    seed: str = "mix", seeds: int = 16, keep_row: bool = True,
) -> DataFrame:
    """(``__row`` or nothing, doc_id, size, source_size, target, copies) per input row.

    Totals, targets and seeds are written first, so that Spark knows their size when it plans the
    join: it broadcasts them below its own threshold, and else splits hot sources (AQE).
    """
    columns = [F.col("doc_id"), F.col("source"), word_count(docs["text"]).alias("size")]
    sized = staged(docs.select(columns), "sizes")
    sizes = staged(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes"
    )
    targets = staged(
        source_targets(sizes, share, most, weights)
        .select(F.col("source").alias("its_source"), "source_size", "target"),
        "source-targets",
    )
    seeded = staged(best_seeds(sized, targets, seed, seeds), "source-seeds")
    rows = docs.select(packed(docs).alias(ROW), *columns) if keep_row else sized
    whole, fraction = rate_parts()
    chance = uniform(F.lit(seed), F.col("seed_number"), F.col("doc_id"), F.col("source"))
    return (
        rows.join(seeded, F.col("source").eqNullSafe(F.col("its_source")))
        .withColumn("copies", (whole + (chance < fraction).cast("long")).cast("long"))
        .drop("its_source", "source", "seed_number")
    )


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each input row as often as it is taken, with its columns as they are."""
    rows = mixed(docs, **options)
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int")))
    return rows.withColumn("__copy", F.explode(times)).select(f"{ROW}.*")
