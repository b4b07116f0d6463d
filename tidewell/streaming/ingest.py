"""Incremental ingestion of JSON-lines event files into the bronze table, with rejects and a log of arrivals.

One stream reads the landing folder. Each micro-batch is parsed once and written with its number to three
tables: the arrivals log, the rejects, and last bronze, which is partitioned by event day. A table
skips a batch that it already has, so a batch repeated after a failure adds nothing. Repeated events are
found by an anti-join with the days that a batch touches; nothing is kept in streaming state.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions import clean
from tidewell.operators.mutation import deduplicate
from tidewell.operators.quality import EVENT_RULES, ISO_PATTERN, QualityCheck, Rule
from tidewell.session import read_text, staged
from tidewell.sources.contract import EVENT_CONTRACT, Contract, parse_with_rescue
from tidewell.sources.tables import TableStore

BRONZE, REJECTS, ARRIVALS = "events_bronze", "events_rejected", "event_arrivals"
DAY = "event_day"


@dataclass(frozen=True)
class IngestSettings:
    """How to read and deduplicate.

    An event is known by its key and its day: a copy of it carries the same time. ``rules`` say which
    events count for features and labels, and so for the arrivals log. ``watermark`` concerns
    ``deduplicated`` alone, which keeps keys in state: None keeps all of them; with a delay such as
    "2 days" the state stays bounded, but Spark drops rows that arrive later than that.
    """

    contract: Contract = EVENT_CONTRACT
    key: str = "event_id"
    entity: str = "customer_id"
    kind: str = "event_type"
    rules: Sequence[Rule] = EVENT_RULES
    time_text: str = "event_timestamp"
    time_pattern: str = ISO_PATTERN
    source_type: str = "event_generator"
    watermark: str | None = None
    max_files_per_trigger: int | None = None


def read_event_stream(spark: SparkSession, landing: str, settings: IngestSettings = IngestSettings()) -> DataFrame:
    """Parsed events with business time, ingestion time and lineage columns.

    Lines are read as text: a JSON stream would take ``year=/month=/day=`` folder names
    for columns and turn a malformed line into an all-null row.
    """
    reader = spark.readStream.schema("value string").option("recursiveFileLookup", "true")
    if settings.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", settings.max_files_per_trigger)
    lines = reader.text(landing).select("value", F.col("_metadata.file_path").alias("_source_file"))
    return enrich(parse_with_rescue(lines, settings.contract), settings)


def enrich(parsed: DataFrame, settings: IngestSettings, at: datetime | None = None) -> DataFrame:
    stamp = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    return parsed.withColumns(
        {
            "event_ts": F.try_to_timestamp(F.col(settings.time_text), F.lit(settings.time_pattern)),
            "ingestion_timestamp": stamp,
            "_source_type": F.lit(settings.source_type),
        }
    )


def usable(settings: IngestSettings) -> Column:
    """Rows that may be deduplicated: they have a key (and a time, under a watermark)."""
    ok = clean.has_text(F.col(settings.key).cast("string"))
    return ok & F.col("event_ts").isNotNull() if settings.watermark else ok


def deduplicated(events: DataFrame, settings: IngestSettings) -> DataFrame:
    """One row per key of a stream that feeds a sink without batch numbers; keys are kept in state."""
    keyed = events.where(usable(settings))
    if settings.watermark:
        return keyed.withWatermark("event_ts", settings.watermark).dropDuplicatesWithinWatermark([settings.key])
    return keyed.dropDuplicates([settings.key])


def rejected(events: DataFrame, settings: IngestSettings) -> DataFrame:
    return events.where(~F.coalesce(usable(settings), F.lit(False)))


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain what is available into a parquet folder, then stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def land_batch(store: TableStore, batch: DataFrame, source: str, number: int, settings: IngestSettings = IngestSettings()) -> None:
    """Write one numbered batch of parsed events; a number that bronze already has is skipped.

    Bronze comes last: while a batch is not in it, a repetition finds the same new events and
    completes the other tables.
    """
    bronze = store.version(BRONZE)
    if bronze and bronze.marks.get(source, -1) >= number:
        return
    once = (source, number)
    with staged(batch, "ingest-batch") as rows:
        dated = rows.where(usable(settings)).withColumn(DAY, F.to_date("event_ts"))
        # The survivor of copies in a batch does not depend on the layout.
        order = ["_source_file", F.xxhash64(*[c for c in dated.columns if c != "ingestion_timestamp"])]
        fresh = deduplicate(dated, [settings.key, DAY], order)
        if bronze:
            days = [r[0] for r in dated.select(DAY).distinct().collect()]  # one per partition touched
            known = store.read_partitions(BRONZE, DAY, days).select(F.col(settings.key).alias("_key"), F.col(DAY).alias("_day"))
            same = (F.col(settings.key) == F.col("_key")) & F.col(DAY).eqNullSafe(F.col("_day"))
            fresh = fresh.join(known, same, "left_anti")
        with staged(fresh, "ingest-new") as new:
            arrived = QualityCheck(new, settings.rules).clean().groupBy(settings.entity, DAY, settings.kind)
            log = arrived.agg(F.count("*").alias("events"), F.max("ingestion_timestamp").alias("arrived_at"))
            log = log.withColumns({"source": F.lit(source), "batch": F.lit(number).cast("long")})
            store.append(ARRIVALS, log, ["source", "batch"], batch=once)
            store.append(REJECTS, rejected(rows, settings), batch=once)
            store.append(BRONZE, new, [DAY], batch=once)


def ingest_events(store: TableStore, landing: str, checkpoint: str, settings: IngestSettings = IngestSettings()) -> StreamingQuery:
    """Drain the files present now into bronze, rejects and the arrivals log, then stop."""

    def land(batch: DataFrame, number: int) -> None:
        # The stream's id stays with its checkpoint; a new checkpoint is a new source of batches.
        source = json.loads(read_text(store.spark, f"{checkpoint}/metadata"))["id"]
        land_batch(store, batch, source, number, settings)

    writer = read_event_stream(store.spark, landing, settings).writeStream.foreachBatch(land)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_summary(bronze: DataFrame) -> DataFrame:
    """Rows in bronze and how many carry rescued fields (a sign that the producer is ahead)."""
    return bronze.agg(
        F.count("*").alias("total_rows"), F.count("_rescued_data").alias("rescued_rows")
    )
