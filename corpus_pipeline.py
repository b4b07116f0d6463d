"""From raw documents to token shards: language, near-duplicates, contamination, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import contamination, language, mixing, near_copies, token_store
from tidewell.llm.common import load
from tidewell.llm.queries import tokenizer_path
from tidewell.session import scratch_path, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; its prediction replaces ``lang``.

    Rejected are texts that are null or hold no letter. The labels of the documents that are not
    held out are what is learned from.
    """
    training = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs.select(*COLUMNS), training, keep=True)
    kept = found.where(F.col("lang_pred") != language.UNKNOWN).select("lang_pred", "row.*")
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word Jaccard of 0.8 or more), that with the smallest doc_id.

    Of rows that repeat this id and the text one stays; rows of one id with other texts count as
    documents of their own.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")
    groups = stage(near_copies.near_copies(docs), "pipeline-groups")
    alike = groups.groupBy("component", "doc_id", "hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "hash", "n")).alias("first")
    stays = alike.groupBy("component").agg(first).select("first.*").select(key, "hash", "n")
    keyed = docs.select(*COLUMNS, key, F.xxhash64(F.col("text").cast("string")).alias("hash"))
    once = keyed.join(stays.where("n = 1"), ["key", "hash"], "left_semi")
    repeated = keyed.join(stays.where("n > 1"), ["key", "hash"], "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows go by id and text: a clean row stays where another of its id, or another without id, leaks.
    """
    keyed = docs.select(*COLUMNS, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("row"))
    leaks = contamination.find_leaks(keyed, load(spark, sf_dir, "benchmark", "item_id", "text"), id_col="row")
    return keyed.join(leaks.select(F.col("doc_id").alias("row")).distinct(), "row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs).where("taken > 0")
    times = mixed.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "hash", (F.col("taken") / F.col("size")).cast("int").alias("times")).distinct()
    keyed = docs.select(*COLUMNS).withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = keyed.withColumn("hash", mixing.row_hash(F.col("doc_id"), F.col("text"))).join(times, ["key", "hash"])
    return rows.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of what is left, read back: doc_id, start, n_tokens, ids_crc32 of each row."""
    folder = scratch_path(spark, "pipeline-tokens")
    manifest, dictionary = token_store.write_token_store(docs, folder, tokenizer_path("byte_bpe_50k.json"))
    return token_store.id_checksums(token_store.read_token_store(manifest, dictionary))


#: In order; each gets all that the one before it kept.
STAGES = [
    ("language", keep_known_language),
    ("near_duplicates", keep_one_of_each),
    ("contamination", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: Automata, shingle sets and token ids are beyond SQL; tests hold each stage and run() against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
