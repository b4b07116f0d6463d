"""Benchmark decontamination: containment search by size-partitioned bottom-k MinHash, with exact checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE, CONTAINMENT = 5, 0.8
#: What stands between words, once a text is in lower case.
BETWEEN = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def _hashed(hashes: str, length: int) -> Column:
    """Hashes of all runs of ``length`` words, from the array column of word hashes."""
    h = F.col(hashes)
    run = F.transform(F.sequence(F.lit(0), F.size(h) - length), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(length)]))
    return F.when(F.size(h) >= length, run).otherwise(F.array().cast("array<bigint>"))


def _shingles(words: str, length: int) -> Column:
    w = F.col(words)
    run = F.transform(F.sequence(F.lit(0), F.size(w) - length), lambda i: F.array_join(F.slice(w, i + 1, length), " "))
    return F.when(F.size(w) >= length, F.array_distinct(run)).otherwise(F.array().cast("array<string>"))


def _needed(n: Column) -> Column:
    """Shingles that a document must share with an item of ``n``: the least whole number of at least 0.8 n."""
    return F.ceil(n * F.lit(CONTAINMENT) - 1e-9).cast("int")


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Rows (doc_id, item_id, n_shared, n_item, containment): documents that hold 0.8 or more of an item.

    Words are runs of letters and digits in lower case; an item is the set of its shingles of five
    words, or its whole word sequence where it has fewer. Items without words match nothing, and so
    do null texts. Rows that repeat an id give one row, with the largest share. Null ids are kept. Texts of
    any length are searched whole; empty tables give no rows; other columns are not read.

    Items are partitioned by size. In a partition of sizes up to u, an item's sketch is its
    k = u - ceil(0.8 u) + 1 smallest hashes: a document that lacks them all lacks too many shingles,
    so that no leak is missed however long the document is. Sketches hold small hashes only, and
    documents are searched with their hashes up to the largest one. Candidates are then checked by
    their full shingle sets.
    """
    listed = items.select(items[item_col].alias("item_id"), _words(items[item_text].cast("string")).alias("words"))
    listed = listed.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(SHINGLE)))
    lengths = sorted(r["length"] for r in listed.select("length").distinct().collect())  # five at most
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    # A row is found again by id and text, so that rows without an id are not one key.
    texts = texts.withColumn("digest", F.xxhash64("text"))

    def of_length(make, column: str) -> Column:
        cases = F.lit(None)
        for n in lengths:
            cases = F.when(F.col("length") == n, make(column, n)).otherwise(cases)
        return cases

    if not lengths:
        return texts.where("false").select(
            "doc_id", F.lit(None).cast(dict(items.dtypes)[item_col]).alias("item_id"), F.lit(0).alias("n_shared"), F.lit(0).alias("n_item"), F.lit(0.0).alias("containment")
        )
    listed = listed.withColumn("shingles", of_length(_shingles, "words"))
    listed = listed.withColumn("n_item", F.size("shingles"))
    hashed = listed.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn("sketch", F.sort_array(F.array_distinct(of_length(_hashed, "h"))))
    upper = F.pow(F.lit(2), F.ceil(F.log2("n_item"))).cast("int")  # the partition's largest size
    sketch = hashed.withColumn("k", upper - _needed(upper) + 1).select(
        "item_id", "length", F.explode(F.slice("sketch", 1, F.col("k"))).alias("probe")
    )
    tops = {r["length"]: r["top"] for r in sketch.groupBy("length").agg(F.max("probe").alias("top")).collect()}

    words = texts.withColumn("h", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)))
    probes = None
    for n in lengths:
        small = F.filter(_hashed("h", n), lambda x: x <= F.lit(tops[n]))  # noqa: B023
        part = words.select("doc_id", "digest", F.lit(n).alias("length"), F.explode(small).alias("probe"))
        probes = part if probes is None else probes.unionByName(part)
    candidates = probes.join(sketch, ["length", "probe"]).select("doc_id", "digest", "item_id", "length").distinct()

    held = candidates.join(listed.select("item_id", "shingles", "n_item"), candidates.item_id.eqNullSafe(listed.item_id)).drop(listed.item_id)
    found = texts.withColumnsRenamed({"doc_id": "id", "digest": "own"}).join(held, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("digest")))
    found = found.withColumn("words", _words(F.col("text")))
    shared = F.size(F.array_intersect(of_length(_shingles, "words"), "shingles"))
    # The filter stands after the aggregate: pushed below, it would split the text anew for every shingle.
    found = found.select("doc_id", "item_id", "n_item", shared.alias("n_shared"))
    best = found.groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))
    best = best.where(F.col("n_shared") >= _needed(F.col("n_item")))
    return best.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
