"""Streaming sources and sinks."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from lakeops.operators.layout import cluster_by
from lakeops.operators.rules import Expectations, Rule, expect, with_violations
from lakeops.session import scratch_dir

# What a micro-batch of an ingest takes, about.
BATCH_BYTES = 256 * 1024 * 1024 * 1024


def read_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None,
                fmt: str = "json", max_bytes: int | None = None) -> DataFrame:
    """Stream the files that arrive under a directory (or path pattern), sub-directories included.

    `max_files` or `max_bytes` bound a micro-batch; without either it takes all files that are new.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def _triggered(writer: DataStreamWriter, checkpoint: str, trigger: str | None) -> DataStreamWriter:
    """`trigger` None: all that is there now, then stop; else a processing-time interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def write_stream(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append a stream to a parquet directory, exactly once across restarts from the checkpoint."""
    writer = df.writeStream.outputMode("append").format("parquet").partitionBy(*partition_by)
    return _triggered(writer, checkpoint, trigger).start(path)


def write_stream_table(df: DataFrame, table: str, checkpoint: str,
                       trigger: str | None = None) -> StreamingQuery:
    """Append a stream to a named table."""
    writer = df.writeStream.outputMode("append").format("parquet")
    return _triggered(writer, checkpoint, trigger).toTable(table)


def write_stream_batches(df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str,
                         trigger: str | None = None) -> StreamingQuery:
    """Hand every micro-batch to `apply(rows, batch_id)`.

    After a failure a batch comes again under the same id; `apply` must leave the same result then.
    """
    return _triggered(df.writeStream.foreachBatch(apply), checkpoint, trigger).start()


def write_stream_clustered(df: DataFrame, path: str, cols: Sequence[str], files: int,
                           checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Append a stream with the rows of every micro-batch clustered by `cols` over `files` files.

    A batch is one `_batch_id` folder, replaced as a whole if the batch is repeated.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        cluster_by(rows, cols, files).write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")

    return write_stream_batches(df, write, checkpoint, trigger)


def write_stream_observed(df: DataFrame, path: str, metrics_path: str, rules: Expectations, checkpoint: str,
                          clean: Callable[[DataFrame], DataFrame] = lambda df: df, trigger: str | None = None) -> StreamingQuery:
    """Append a stream that meets expectations (`rules.expect`), with the counts of each micro-batch kept beside it.

    Rows and counts of a batch are folders named by its id, replaced if it is repeated. So counts outlast the query, its
    restarts, and the few batches that its progress remembers. Read them with `observed_counts`.
    """

    def apply(rows: DataFrame, batch_id: int) -> None:
        seen = Observation(f"expectations-{batch_id}")
        clean(expect(rows, rules, seen)).write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")
        counts = [(name, seen.get[name], seen.get["_records"]) for name in rules]
        (rows.sparkSession.createDataFrame(counts, "expectation string, failed bigint, records bigint").coalesce(1)
         .write.mode("overwrite").parquet(f"{metrics_path}/_batch_id={batch_id}"))

    return write_stream_batches(df, apply, checkpoint, trigger)


def observed_counts(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Failures of each expectation and records seen, over all batches."""
    return spark.read.parquet(metrics_path).groupBy("expectation").agg(F.sum("failed").alias("failed"), F.sum("records").alias("records"))


PARTS = ("good", "quarantined", "late")


def write_stream_parts(df: DataFrame, path: str, rules: Sequence[Rule], ts: str, delay: str, checkpoint: str,
                       trigger: str | None = None) -> StreamingQuery:
    """Deal each micro-batch out in one pass: rows that come too late, rows that break a rule, and good ones.

    Late are rows whose `ts` lies more than `delay` before the greatest of earlier batches; that watermark is kept with each batch,
    a row, and a repeated batch goes by those before it. A batch is one folder, replaced if it is repeated, with a
    folder for each part: all three appear together, and add up to the batch. Rows without a time aren't late. Read them with `part_of`.
    """

    def apply(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        seen = None
        if batch_id:
            kept = spark.read.schema("latest timestamp, _batch_id bigint").parquet(f"{path}/marks")
            seen = kept.where(F.col("_batch_id") < batch_id).agg(F.max("latest").alias("latest")).first()["latest"]
        late = F.lit(False) if seen is None else F.coalesce(
            F.col(ts).cast("timestamp") < F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(False))
        marked = with_violations(rows, rules)
        part = F.when(late, "late").when(F.size("violations") > 0, "quarantined").otherwise("good")
        latest = Observation(f"latest-{batch_id}")
        (marked.withColumn("part", part).observe(latest, F.max(F.col(ts).cast("timestamp")).alias("latest"))
         .write.mode("overwrite").partitionBy("part").parquet(f"{path}/rows/_batch_id={batch_id}"))
        (spark.createDataFrame([(latest.get["latest"],)], "latest timestamp").coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/marks/_batch_id={batch_id}"))

    return write_stream_batches(df, apply, checkpoint, trigger)


def part_of(spark: SparkSession, path: str, part: str, schema: StructType) -> DataFrame:
    """One of `PARTS` of a stream's rows, with the names of broken rules; `schema` is that of the stream."""
    kind = StructType([*schema.fields, StructField("violations", ArrayType(StringType())), StructField("part", StringType())])
    return spark.read.schema(kind).parquet(f"{path}/rows").where(F.col("part") == part).select(*schema.names, "violations")


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query to end by itself, and raise what made it fail."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def ingest_new_files(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: StructType,
                     fmt: str = "parquet", max_bytes: int | None = BATCH_BYTES, add: Callable[[DataFrame], DataFrame] = lambda df: df,
                     ) -> StreamingQuery:
    """Append all files that have arrived since the last run to `dst`.

    The checkpoint remembers which files are done: a second run takes only new ones. A micro-batch
    takes about `max_bytes`, so that a first run over a huge folder makes lasting progress.
    """
    return finish(write_stream(add(read_stream(spark, src, schema, fmt=fmt, max_bytes=max_bytes)), dst, checkpoint))


RESCUED = "_rescued"


def evolved(known: StructType, found: StructType) -> StructType:
    """The known fields as they are, and the new ones behind them."""
    return StructType([*known.fields, *[f for f in found.fields if f.name not in known.names]])


def parsed(lines: DataFrame, schema: StructType) -> DataFrame:
    """JSON texts in `value` by a schema; `_rescued` holds, as texts by name, the values that don't fit their column's type, and lines that are
    no JSON object under an empty name; NULL if there are none."""
    texts = F.from_json("value", "map<string,string>")
    row = lines.select("value", F.from_json("value", schema).alias("_row"), texts.alias("_texts"))
    lost = F.map_filter("_texts", lambda name, text: text.isNotNull() & F.coalesce(
        F.element_at(F.create_map(*[x for f in schema.fields for x in (F.lit(f.name), F.col("_row").getField(f.name).isNull())]), name), F.lit(True)))
    broken = F.col("_texts").isNull() & (F.trim("value") != "")
    rescued = F.when(broken, F.create_map(F.lit(""), F.col("value"))).when(F.size(lost) > 0, lost)
    return row.select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields], rescued.alias(RESCUED))


def _inferred(lines: DataFrame) -> StructType:
    """The schema of JSON texts, columns in the order of their names; those that are no object, and all NULL columns as texts."""
    path = scratch_dir(lines.sparkSession, "lines")
    lines.select("value").write.text(path)
    found = lines.sparkSession.read.json(path).schema
    return StructType([f for f in found.fields if f.name != "_corrupt_record"])


def stored_schema(spark: SparkSession, schema_path: str, before: int | None = None) -> StructType:
    """The newest schema kept (of the batches before one); empty if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(schema_path)
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        return StructType([])
    kept = spark.read.schema("schema string, _batch_id bigint").parquet(schema_path)
    kept = kept if before is None else kept.where(F.col("_batch_id") < before)
    newest = kept.agg(F.max_by("schema", "_batch_id").alias("schema")).first()["schema"]
    return StructType.fromJson(json.loads(newest)) if newest else StructType([])


def read_evolving(spark: SparkSession, dst: str, schema_path: str) -> DataFrame:
    """All rows under the newest schema; columns that came later are NULL in older ones."""
    rescued = StructField(RESCUED, MapType(StringType(), StringType()))
    return spark.read.schema(StructType([*stored_schema(spark, schema_path).fields, rescued])).parquet(dst)


def ingest_evolving(spark: SparkSession, src: str, dst: str, schema_path: str, checkpoint: str,
                    max_bytes: int | None = BATCH_BYTES) -> StreamingQuery:
    """Append new JSON files to `dst` under a schema that grows with them.

    The schema is kept at `schema_path`, a version for each batch that met new columns; it takes them with the type they have there. Known
    columns keep their type: values that don't fit it are kept in `_rescued`, so that none is lost. A batch is one folder, replaced
    if it is repeated. Read with `read_evolving`.
    """

    def apply(lines: DataFrame, batch_id: int) -> None:
        found = _inferred(lines)
        known = stored_schema(spark, schema_path, before=batch_id)
        schema = evolved(known, found)
        if schema != known:
            (spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite")
             .parquet(f"{schema_path}/_batch_id={batch_id}"))
        parsed(lines, schema).write.mode("overwrite").parquet(f"{dst}/_batch_id={batch_id}")

    text = StructType([StructField("value", StringType())])
    return finish(write_stream_batches(read_stream(spark, src, text, fmt="text", max_bytes=max_bytes), apply, checkpoint))
