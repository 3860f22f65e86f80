"""The provider feed: building and publishing events, validating them as a stream or a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions.numbers import parse_number
from plumbline.functions.text import is_blank, literals
from plumbline.rules.vocabulary import COUNTRIES
from plumbline.schemas import EVENT, MANIFEST, PROVIDER_FEED
from plumbline.sources.tables import null_nans
from plumbline.session import fresh_path

EVENT_TYPE = "provider_record_received"
PREVIEW_ROWS = 100

# The three event issues and the texts they are reported by.
MISSING_NAME = "Missing legal name"
INVALID_COUNTRY = "Invalid country code"
INVALID_SCORE = "Invalid confidence score"


def number_rows(df: DataFrame, path: str) -> DataFrame:
    """Add ``sequence_number``, 1 to n over all rows without gaps, at any size.

    The rows are written once with their task and their place in the task. The counts per task then
    give each task its offset, so no task ever sees more than its own rows. Reading the written
    table keeps the numbers the same however often it is read.
    """
    spark = df.sparkSession
    df.selectExpr(
        "*", "spark_partition_id() AS __task", "monotonically_increasing_id() & 8589934591L AS __place"
    ).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    # One row per task.
    sizes = written.groupBy("__task").agg(F.expr("count(*) AS __size"))
    offsets = sizes.selectExpr(
        "__task", "sum(__size) OVER (ORDER BY __task ROWS UNBOUNDED PRECEDING) - __size AS __offset"
    )
    joined = written.join(F.broadcast(offsets), "__task")
    return joined.selectExpr(*df.columns, "__offset + __place + 1 AS sequence_number")


def first_records(feed: DataFrame, limit: int) -> DataFrame:
    """The first records in key order with their sequence numbers, at most ``limit``."""
    columns = [f.name for f in PROVIDER_FEED.fields]
    few = feed.select(*columns).orderBy(*columns).limit(limit)
    order = ", ".join(columns)
    return few.selectExpr("*", f"CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS sequence_number")


def build_events(numbered: DataFrame, run_id: str) -> DataFrame:
    """Wrap numbered provider records into event envelopes. NaN becomes null.

    The event id is derived from the run and the sequence number, so building the events again, after
    an executor was lost for instance, gives the same ids.
    """
    fields = ", ".join(
        f"'{f.name}', CAST({f.name} AS STRING)" for f in PROVIDER_FEED.fields
    )
    run = f"'{run_id}'"
    return null_nans(numbered).selectExpr(
        f"sha2(concat_ws(':', {run}, sequence_number), 256) AS event_id",
        f"{run} AS run_id",
        f"'{EVENT_TYPE}' AS event_type",
        "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\") AS event_time",
        "sequence_number",
        "provider_record_id AS key",
        f"named_struct({fields}) AS payload",
    )


def encode(events: DataFrame) -> DataFrame:
    """Message key, the record id or else the event id, and the event as JSON with its nulls."""
    packed = ", ".join(f.name for f in EVENT.fields)
    return events.selectExpr(
        "coalesce(key, event_id) AS key",
        f"to_json(struct({packed}), map('ignoreNullFields', 'false')) AS value",
    )


def publish_files(messages: DataFrame, path: str) -> str:
    """Publish as JSON lines; a stand-in for a topic where no broker is at hand."""
    messages.select("value").write.mode("append").text(path)
    return path


def publish_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish to a topic. Needs the Kafka connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_counted(messages: DataFrame, publish: Callable[[DataFrame], object]) -> int:
    """Publish and return how many messages went out, counted by the tasks of that write; nothing is read back.

    Spark takes the count of a task that was repeated once.
    """
    seen = Observation("published")
    publish(messages.observe(seen, F.count(F.lit(1)).alias("messages")))
    return seen.get["messages"]


def write_manifest(spark: SparkSession, path: str, run_id: str, topic: str, published_count: int, server: str = "") -> None:
    """One JSON object with the facts of a run."""
    spark.range(1).selectExpr(
        f"'{run_id}' AS run_id", f"'{topic}' AS topic", f"'{server}' AS bootstrap_server", f"{published_count}L AS published_count",
        "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\") AS created_at",
    ).coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(path, multiLine=True)


def decode(lines: DataFrame) -> DataFrame:
    """JSON text in ``value`` to event columns; text that is no event gives an event of nulls."""
    parsed = lines.select(F.from_json(F.col("value").cast("string"), EVENT).alias("event"))
    return parsed.select("event.*")


def stream_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode(reader.load(path))


def stream_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Events of a topic from its beginning. Needs the Kafka connector on the class path."""
    return decode(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def validate_events(events: DataFrame, run_id: str | None = None) -> DataFrame:
    """Status and issues of every event of a run. The same projection for streams and batches."""
    chosen = events if run_id is None else events.where(F.col("run_id") == run_id)
    score = parse_number("payload.confidence_score")
    checks = {
        MISSING_NAME: is_blank("payload.legal_name"),
        INVALID_COUNTRY: f"coalesce(payload.country_code NOT IN ({literals(COUNTRIES)}), true)",
        INVALID_SCORE: f"NOT coalesce({score} BETWEEN 0 AND 1, false)",
    }
    found = ", ".join(f"CASE WHEN {condition} THEN '{text}' END" for text, condition in checks.items())
    return chosen.selectExpr("*", f"array_compact(array({found})) AS __issues").selectExpr(
        "event_id", "run_id", "event_type", "event_time", "sequence_number",
        "payload.provider_record_id AS provider_record_id", "payload.provider_name AS provider_name",
        "payload.legal_name AS legal_name", "payload.country_code AS country_code",
        "payload.confidence_score AS confidence_score",
        "CASE WHEN size(__issues) > 0 THEN 'failed' ELSE 'passed' END AS status",
        "size(__issues) AS issue_count", "array_join(__issues, '; ') AS issues",
        "current_timestamp() AS validated_at",
    )


def run_validation(
    events: DataFrame, run_id: str, output: str, archive: str | None = None, require: bool = False
) -> StreamingQuery:
    """Validate everything that has arrived so far and stop.

    One stream reads the source once and writes both outputs of a batch: validated events in one folder per status, so
    that the failed ones are read without touching the rest, and the raw events of the run as JSON lines. Each
    batch has a folder of its own, named by its id and written anew when a batch is repeated after a restart, so
    every event is kept exactly once. With ``require`` a run without any event so far is an error.
    """
    schema = validate_events(events, run_id).schema

    def keep(batch: DataFrame, batch_id: int) -> None:
        chosen = batch.where(F.col("run_id") == run_id).persist()
        try:
            _write_batch(validate_events(chosen, run_id), output, batch_id)
            if archive is not None:
                _archive_batch(chosen, archive, batch_id)
        finally:
            chosen.unpersist()

    query = events.writeStream.foreachBatch(keep).option("checkpointLocation", f"{output}-checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if require:
        try:
            require_events(events.sparkSession.read.schema(schema).parquet(output))
        except AnalysisException:  # no batch at all, so no folder
            raise RuntimeError("no event of the run was consumed") from None
    return query


def _write_batch(validated: DataFrame, output: str, batch_id: int) -> None:
    validated.write.mode("overwrite").partitionBy("status").parquet(f"{output}/batch_id={batch_id}")


def _archive_batch(events: DataFrame, archive: str, batch_id: int) -> None:
    events.write.mode("overwrite").json(f"{archive}/batch_id={batch_id}")


def run_summary_stream(events: DataFrame, run_id: str, output: str) -> DataFrame:
    """The feed summary kept up to date by a stream, read back as of everything that has arrived so far.

    The state is one row per provider and status. Every batch writes the whole summary to the folder of its id; the
    latest one counts. ``feed_summary`` gives the same from the written events.
    """
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    summary = feed_summary(validate_events(events, run_id))
    query = (
        summary.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{output}-checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    written = events.sparkSession.read.schema(summary.schema).parquet(output)
    latest = written.agg(F.expr("max(batch_id) AS batch_id"))
    return written.join(F.broadcast(latest), "batch_id").drop("batch_id")


def feed_summary(validated: DataFrame) -> DataFrame:
    """Events and issues by provider and status; events without provider are a group of their own."""
    return validated.groupBy("provider_name", "status").agg(
        F.expr("count(event_id) AS event_count"), F.expr("sum(issue_count) AS total_issues")
    )


def failed_events(validated: DataFrame) -> DataFrame:
    return validated.where("status = 'failed'")


def completeness(validated: DataFrame, manifest: DataFrame) -> DataFrame:
    """Consumed against published events of each run in the manifest."""
    consumed = validated.groupBy("run_id").agg(F.expr("count(*) AS consumed_count"))
    joined = manifest.select("run_id", "published_count").join(consumed, "run_id", "left")
    return joined.selectExpr(
        "run_id", "published_count", "coalesce(consumed_count, 0L) AS consumed_count",
        "coalesce(consumed_count, 0L) = published_count AS complete",
    )


def require_events(validated: DataFrame) -> DataFrame:
    """Fail when a run has no event at all."""
    if validated.isEmpty():
        raise RuntimeError("no event of the run was consumed")
    return validated


def preview_events(spark: SparkSession, path: str, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first archived events in sequence order."""
    return spark.read.schema(EVENT).json(path).orderBy("sequence_number", "event_id").limit(n)


def feed_run(feed: DataFrame, run_id: str, limit: int | None = None) -> tuple[str, str]:
    """Publish a run of the whole feed, or of its first records, as files below the shared folder; returns messages and manifest."""
    spark = feed.sparkSession
    folder = fresh_path(spark, "feed")
    columns = [f.name for f in PROVIDER_FEED.fields]
    if limit is None:
        numbered = number_rows(feed.select(*columns), f"{folder}/numbered")
    else:
        numbered = first_records(feed, limit)
    messages = f"{folder}/messages"
    count = publish_counted(encode(build_events(numbered, run_id)), lambda m: publish_files(m, messages))
    write_manifest(spark, f"{folder}/manifest", run_id, messages, count)
    return messages, f"{folder}/manifest"
