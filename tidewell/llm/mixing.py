"""Mixing sources to target weights with histograms of a hash, without a sort of the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import WORD
from tidewell.session import stage

#: Weights of the sources in code-point order, repeated.
WEIGHTS = (5, 2, 1)
#: No source gives more than this many times its own size.
REPEATS = 3
#: Bits of the 60-bit hash that each histogram splits, from the top.
BITS = (12, 12, 36)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the id and the text together."""
    text = F.md5(F.coalesce(text.cast("string"), F.lit("")))
    digest = F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), text))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, source_size and target of each source, from (source, source_size).

    Targets share the sum of all sizes by weight; one that exceeds ``repeats`` times its source's
    size stops there and the excess is shared again. Capped sources are those with the smallest
    room per weight, so that running sums over the sources in that order find the common share.
    The windows run over one row per source, never over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("room", F.lit(repeats) * F.col("source_size"))
    by_room = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "total": F.sum("source_size").over(all_rows),
            "used": F.coalesce(F.sum("room").over(before), F.lit(0)),
            "left": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    # At a source, the share if all smaller ones are capped; the first that it does not exceed ends the capping.
    share = (F.col("total") - F.col("used")) / F.col("left")
    rows = rows.withColumn("share", F.when(share * F.col("weight") <= F.col("room"), share))
    common = F.min_by("share", F.when(F.col("share").isNotNull(), F.col("room") / F.col("weight"))).over(all_rows)
    rows = rows.withColumn("common", common)
    capped = F.col("common").isNull() | (F.col("room") / F.col("weight") < F.col("common"))
    target = F.when(capped, F.col("room").cast("double")).otherwise(F.col("common") * F.col("weight"))
    return rows.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken, hash.

    ``size`` counts the words (null text: 0). A document is taken as often as its source's target
    holds the source's size in full, and once more where its hash is below the source's threshold:
    the place in hash order where the running size comes nearest to the rest. A histogram over the
    top bits finds the bucket that holds this place, and finer ones split that bucket alone. The
    hash is of the id and the text, so that reruns agree; rows that repeat both are taken or left
    together. A null source is a source of its own, the last one. Sources without words have
    target 0, and an empty table gives no rows. Words are counted over whole texts of any length; columns
    other than the three are not read. The query plans grow with the number of sources and buckets, never by document.
    """
    sized = stage(
        docs.select(
            docs[id_col].cast("long").alias("doc_id"),
            docs[source_col].cast("string").alias("source"),
            word_count(docs[text_col].cast("string")).alias("size"),
            row_hash(docs[id_col], docs[text_col]).alias("hash"),
        ),
        "mix-sizes",
    )
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats)
    plan = plan.withColumn("whole", F.floor(F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0))))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = stage(plan.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), "mix-plan")

    keyed = sized.select("hash", "size", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key"))
    edge = plan.select("key", "rest", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("done"))
    inside, shift = keyed, sum(BITS)
    for bits in BITS:
        width, shift = shift, shift - bits
        at = F.shiftright("hash", shift)
        # Rows of the boundary buckets only; at the first level that is all rows.
        found = inside.join(edge, "key").where(F.shiftright("hash", width) == F.shiftright("low", width))
        sums = found.groupBy("key", "rest", "done", at.alias("bucket")).agg(F.sum("size").alias("in_bucket"))
        running = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("done", F.col("done") + F.coalesce(F.sum("in_bucket").over(running), F.lit(0)))
        # The bucket that the rest falls into; at the last level the first whose middle lies beyond
        # it, or the end of the bucket where none does.
        beyond = F.col("done") + (F.col("in_bucket") / 2 if shift == 0 else F.col("in_bucket")) > F.col("rest")
        first = sums.where(beyond).groupBy("key").agg(F.min_by(F.struct("bucket", "done"), "bucket").alias("b"))
        end = F.shiftleft(F.shiftright("low", width) + 1, width)
        edge = edge.join(first, "key", "left").select(
            "key", "rest", F.coalesce(F.shiftleft("b.bucket", shift), end).alias("low"), F.coalesce("b.done", "done").alias("done")
        )
        edge = stage(edge, "mix-edge")
    limits = plan.join(edge.select("key", F.col("low").alias("threshold")), "key")
    limits = limits.select("key", "source_size", "target", "whole", "threshold")
    once_more = (F.col("hash") < F.col("threshold")) & (F.col("whole") < repeats)
    times = F.least(F.col("whole") + F.when(once_more, 1).otherwise(0), F.lit(repeats))
    return (
        sized.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
        .join(limits, "key")
        .select("doc_id", "size", "source", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"), "hash")
    )
