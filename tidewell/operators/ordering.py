"""Running totals, exact quantiles and hash cuts over groups of any size.

A window with ``partitionBy(group)`` puts a whole group into one task. The
operators here first collapse each group to its distinct values, cut the values
into range slices that ignore group borders, and add per-slice offsets, so a
group that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import stage

SLICE = "_slice"


def running_totals(
    counts: DataFrame,
    groups: Sequence[str],
    value: str,
    measures: Sequence[str],
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<m>`` and ``all_<m>`` for each measure: total up to this value, and of the group.

    ``counts`` must hold one row per (groups, value), with non-null groups. The
    rows are written once to the scratch folder, because the slice number comes
    from the physical layout and must be the same for rows and offsets.
    """
    groups = list(groups)
    order = F.col(value).desc() if descending else F.col(value).asc()
    sliced = stage(
        counts.repartitionByRange(*groups, order).withColumn(SLICE, F.spark_partition_id()),
        "slices",
    )

    # One row per slice and group. There may be as many groups as rows, so the offsets are dealt
    # like the slices and joined in place, not broadcast; a group has at most one row per slice.
    per_slice = sliced.groupBy(*groups, SLICE).agg(*[F.sum(m).alias(f"_s_{m}") for m in measures])
    by_group = Window.partitionBy(*groups)
    earlier = by_group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *groups,
        SLICE,
        *[F.coalesce(F.sum(f"_s_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(by_group).alias(f"all_{m}") for m in measures],
    )

    inside = (
        Window.partitionBy(*groups, SLICE)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = sliced.select("*", *[F.sum(m).over(inside).alias(f"_l_{m}") for m in measures])
    # The window has dealt and sorted the rows by group and slice: a merge moves only the offsets.
    joined = local.join(offsets.hint("merge"), [*groups, SLICE])
    return joined.select(
        *counts.columns,
        *[(F.col(f"_l_{m}") + F.col(f"_o_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"all_{m}") for m in measures],
    )


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add the place of each row in a total order, from 1; no task sees more than a slice.

    Rows are cut into ranges, ranked inside them, and moved on by the number of rows in the ranges
    before. Rows that ``order`` holds for equal follow each other by a hash of their values, so that many
    ties do not fall into one range; copies of a row take neighbouring places.
    """
    ties = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    keyed = df.withColumn("_tie", ties)
    full = [*order, F.col("_tie").asc()]
    sliced = stage(keyed.repartitionByRange(*full).withColumn(SLICE, F.spark_partition_id()), "ranked")
    # One row per range, so their number is that of the partitions.
    sizes = sliced.groupBy(SLICE).agg(F.count("*").alias("_n"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(SLICE).orderBy(*full))
    ranked = sliced.withColumn("_place", inside).join(offsets, SLICE)
    return ranked.select(*[f"`{c}`" for c in df.columns], (F.col("_place") + F.col("_before")).alias(name))


def quantile_columns(
    value: str, weight: str, points: Sequence[float], prefix: str = "q"
) -> list[Column]:
    """Aggregates over ``running_totals`` output: exact linear-interpolated quantiles.

    Rank k of n (from 0) is the smallest value whose running weight exceeds k, so
    each point needs two conditional minimums and no sorting of the group.
    """
    total, upto = f"all_{weight}", f"cum_{weight}"
    out = []
    for i, p in enumerate(points):
        position = f"(({total} - 1) * {float(p)!r}D)"
        low = f"min({value}) FILTER (WHERE {upto} > floor({position}))"
        high = f"min({value}) FILTER (WHERE {upto} > ceil({position}))"
        share = f"max({position} - floor({position}))"
        out.append(F.expr(f"{low} + ({high} - {low}) * {share} AS {prefix}{i}"))
    return out


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, points: Sequence[float]
) -> DataFrame:
    """Exact quantiles per group as an array column ``quantiles``, plus ``n_values``.

    Nulls and NaN are left out, as are groups whose key is null.
    """
    groups = list(groups)
    v = F.col(value).cast("double")
    counts = (
        df.where(v.isNotNull() & ~F.isnan(v))
        .dropna(subset=groups)
        .groupBy(*groups, v.alias("_v"))
        .agg(F.count("*").alias("n"))
    )
    totals = running_totals(counts, groups, "_v", ["n"])
    picked = totals.groupBy(*groups).agg(
        F.max("all_n").alias("n_values"), *quantile_columns("_v", "n", points)
    )
    return picked.select(
        *groups,
        "n_values",
        F.array(*[F.col(f"q{i}") for i in range(len(points))]).alias("quantiles"),
    )


def hash_cuts(
    df: DataFrame,
    stratum: str,
    key: str,
    digest: Column,
    percents: Sequence[int],
    prefix_hex: int = 4,
) -> DataFrame:
    """For each stratum, the (digest, key) at rank floor(n * percent / 100) in digest order.

    Digests are uniform, so their leading hex digits cut every stratum into even
    buckets without sampling. Only the buckets that hold a cut are ranked. Ranks
    count rows; where a key has several copies the cut moves past all of them. Returns
    one row per stratum with ``cut_<percent>`` structs (null when the rank is 0).
    """
    keyed = df.select(
        F.col(stratum).alias("_stratum"), F.col(key).alias("_key"), digest.alias("_digest")
    ).where(F.col("_stratum").isNotNull())
    keyed = keyed.withColumn("_bucket", F.substring("_digest", 1, prefix_hex))

    per_bucket = keyed.groupBy("_stratum", "_bucket").agg(F.count("*").alias("n"))
    by_stratum = Window.partitionBy("_stratum")
    ranks = F.array(
        *[
            F.struct(
                F.lit(p).alias("percent"),
                F.floor(F.col("total") * F.lit(p) / F.lit(100)).cast("long").alias("rank"),
            )
            for p in percents
        ]
    )
    # Bounded by 16^prefix_hex rows per stratum whatever the table size.
    cut_buckets = (
        per_bucket.select(
            "*",
            F.sum("n").over(by_stratum).alias("total"),
            F.sum("n")
            .over(by_stratum.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
            .alias("upto"),
        )
        .withColumn("cut", F.explode(ranks))
        .where((F.col("cut.rank") <= F.col("upto")) & (F.col("cut.rank") > F.col("upto") - F.col("n")))
        .select(
            "_stratum",
            "_bucket",
            F.col("cut.percent").alias("percent"),
            (F.col("cut.rank") - F.col("upto") + F.col("n")).alias("want"),
        )
    )
    # At most one row per stratum and percent. Copies of a key share a digest, so
    # they are collapsed before the ranking; a key is never split between sides.
    in_cut = (
        keyed.join(F.broadcast(cut_buckets), ["_stratum", "_bucket"])
        .groupBy("_stratum", "percent", "want", "_digest", "_key")
        .agg(F.count("*").alias("copies"))
    )
    upto = F.sum("copies").over(
        Window.partitionBy("_stratum", "percent")
        .orderBy("_digest", "_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    chosen = in_cut.withColumn("_upto", upto).where(
        (F.col("_upto") >= F.col("want")) & (F.col("_upto") - F.col("copies") < F.col("want"))
    )
    return chosen.groupBy(F.col("_stratum").alias(stratum)).agg(
        *[
            F.max(
                F.when(F.col("percent") == p, F.struct("_digest", "_key"))
            ).alias(f"cut_{p}")
            for p in percents
        ]
    )
