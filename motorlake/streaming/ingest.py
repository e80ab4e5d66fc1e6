"""Structured Streaming: incremental CSV ingest, watermarked dedup and daily KPI,
row hash on a stream, and an SCD2 dimension fed by a change stream.

All queries run with ``trigger(availableNow=True)`` into sinks with a
checkpoint, so a restarted query resumes from its file-source log and never
reads a committed file twice.  Working folders are unique sub-folders of the
cluster's shared folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType)

from ..functions.exact import cents, from_cents
from ..operators import scd2
from ..operators.dedup import dedup_first
from ..sources import feeds

# Event file layout and the stream semantics asked for.
EVENT_SCHEMA = StructType([
    StructField("event_id", LongType(), True),
    StructField("ts", TimestampNTZType(), True),
    StructField("user_id", LongType(), True),
    StructField("event_type", StringType(), True),
    StructField("value", DoubleType(), True),
    StructField("props", StringType(), True),
])
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": TS_FORMAT, "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
TRANSACTION_WATERMARK = "3 days"
MASTER_WATERMARK = "7 days"            # dimension feeds may be later than transactions
DAYS_PER_CHUNK = 3
DUPLICATE_MODULUS = 20                 # every 20th event (5 %) is sent again at the end
FILES_PER_EPOCH = 1000                 # files of one micro-batch of a feed; more make more batches
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def csv_reader_options(reader):
    for k, v in CSV_OPTIONS.items():
        reader = reader.option(k, v)
    return reader


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """``compression``: "gzip" takes about a third of the room, but a file is then read by one task."""
    w = df.write.mode("overwrite").option("compression", compression)
    for k, v in CSV_OPTIONS.items():
        w = w.option(k, v)
    w.csv(path)


def stage_events(events: DataFrame, staging: str) -> list[int | None]:
    """One partitioned write of all events by chunk: ``DAYS_PER_CHUNK`` days from the data's own first
    day, events without a time in a chunk of their own (None). Returns the chunks in time order."""
    first = events.agg(F.to_date(F.min("ts")).alias("d")).first()["d"]
    chunk = F.floor(F.datediff(F.to_date("ts"), F.lit(first).cast("date")) / DAYS_PER_CHUNK).cast("int")
    events.withColumn("_chunk", chunk).write.mode("overwrite").partitionBy("_chunk").parquet(staging)
    staged = StructType([*events.schema, StructField("_chunk", IntegerType(), True)])
    found = events.sparkSession.read.schema(staged).parquet(staging).select("_chunk").distinct().collect()
    return sorted((r["_chunk"] for r in found), key=lambda c: (c is None, c or 0))


def land_chunks(spark: SparkSession, staging: str, landing: str, chunks: Sequence[int | None]) -> None:
    """Deliver staged chunks as CSV folders, one after another, so file times follow delivery; each
    chunk's write reads its own partition only."""
    staged = spark.read.schema(StructType([*EVENT_SCHEMA, StructField("_chunk", IntegerType(), True)])).parquet(staging)
    for c in chunks:
        name = "none" if c is None else f"{c:05d}"
        write_csv(staged.filter(F.col("_chunk").eqNullSafe(F.lit(c).cast("int"))).drop("_chunk"), f"{landing}/chunk_{name}")


def land_copies(events: DataFrame, landing: str) -> None:
    """Deliver the re-sent events."""
    write_csv(events.filter(F.col("event_id") % DUPLICATE_MODULUS == 0), f"{landing}/dups")


def read_events_stream(spark: SparkSession, landing: str, files_per_trigger: int | None = None,
                       path_contains: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENT_SCHEMA)
    reader = csv_reader_options(reader)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.csv(f"{landing}/*")
    if path_contains is not None:
        df = df.filter(F.col("_metadata.file_path").contains(path_contains))
    return df


def with_event_time(df: DataFrame) -> DataFrame:
    """Watermarks need TIMESTAMP; the feed carries TIMESTAMP_NTZ (session time zone is UTC)."""
    return df.withColumn("event_time", F.col("ts").cast("timestamp"))


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    q = (stream.writeStream.format("parquet").outputMode(mode)
         .option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def dedup_events(stream: DataFrame, watermark: str = TRANSACTION_WATERMARK) -> DataFrame:
    """Drop re-sent events: bounded state, keys expire once the watermark passes them."""
    return (with_event_time(stream).withWatermark("event_time", watermark)
            .dropDuplicatesWithinWatermark(["event_id"]).drop("event_time"))


def daily_event_kpi(stream: DataFrame, watermark: str = TRANSACTION_WATERMARK) -> DataFrame:
    """Tumbling one-day windows per event type; a window is emitted once the
    watermark passes its end, rows arriving after that are dropped as late."""
    agg = (with_event_time(stream).withWatermark("event_time", watermark)
           .groupBy(F.window("event_time", "1 day"), "event_type")
           .agg(F.count(F.lit(1)).alias("events"), F.sum(cents("value")).alias("_v")))
    return agg.select(F.to_date(F.col("window.start")).alias("day"), "event_type", "events",
                      from_cents("_v").alias("total_value"))


def master_changes(stream: DataFrame, key: str, time_col: str, watermark: str = MASTER_WATERMARK) -> DataFrame:
    """Dimension rows once for each key and row hash while copies are at most ``watermark`` late."""
    return stream.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark([key, "_row_hash"])


def scd2_stream_apply(spark: SparkSession, snapshots_stream: DataFrame, key: str, history_root: str,
                      checkpoint: str, empty: DataFrame) -> scd2.VersionedHistory:
    """Merge each micro-batch of dimension snapshots (with ``_snapshot_ts``) into a ``VersionedHistory``.

    Epoch e writes version e + 1 from the highest committed version below it, so a restarted
    query goes on from what is committed and a replayed batch gives the same version again. The
    snapshots of a batch and the current rows form one change log, merged in one pass.
    """
    store = scd2.VersionedHistory(spark, history_root)

    def apply(batch: DataFrame, epoch: int) -> None:
        base = store.latest(below=epoch + 1)
        now = (store.read(base) if base is not None else empty).filter("is_current")
        ts = F.col("_snapshot_ts").cast("timestamp_ntz")
        new = dedup_first(batch.withColumn("_snapshot_ts", ts), [key, "_snapshot_ts"])
        log = new.withColumnsRenamed({"_snapshot_ts": "_ts"}).withColumn("_ingest_ts", F.col("_ts")).unionByName(
            now.withColumn("_ts", F.col("scd_start_date")).drop("scd_start_date", "scd_end_date", "is_current"))
        rows = scd2.scd2_from_log(log, key, "_ts").drop("_ts").select(*empty.columns)
        store.write(epoch + 1, rows, f"epoch {epoch}")

    q = (snapshots_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return store


def ingest_feed(spark: SparkSession, landing: str, out: str, checkpoint: str, feed: str, multi_line: bool = False) -> DataFrame:
    """Read newly landed CSV files of a feed once, by column name, into Parquet under ``out``.

    The file source only tracks the files; each batch's files are read by ``feeds.read_feed``, so their
    columns may be reordered, missing or new. Every epoch writes its own folder (a replay rewrites
    it), malformed rows included (see ``rejected_rows``). Returns the well-formed rows with the
    columns of all epochs. The columns of every file are logged next to ``out`` (see ``schema_log``).
    """
    def apply(batch: DataFrame, epoch: int) -> None:
        files = [r["path"] for r in batch.select("path").collect()]     # the files of one trigger
        columns = feeds.header_columns(spark, files)
        log = spark.createDataFrame([(f, list(c)) for f, c in columns.items()], "file string, columns array<string>")
        log.coalesce(1).write.mode("overwrite").parquet(f"{schema_log_path(out)}/epoch={epoch:06d}")
        feeds.read_feed_rows(spark, files, feed, multi_line, columns).write.mode("overwrite").parquet(f"{out}/epoch={epoch:06d}")

    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("maxFilesPerTrigger", FILES_PER_EPOCH).load(landing).select("path")
    q = files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.option("mergeSchema", "true").parquet(out)
    return rows.filter("_malformed IS NULL").drop("epoch", "_malformed", "_file")


def rejected_rows(spark: SparkSession, out: str) -> DataFrame:
    """(_file, _malformed): the rows that ``ingest_feed`` could not read."""
    return spark.read.option("mergeSchema", "true").parquet(out).filter("_malformed IS NOT NULL").select("_file", "_malformed")


def schema_log_path(out: str) -> str:
    return f"{out.rstrip('/')}_schemas"


def _path_key(c: str):
    """One spelling of a file's path: listings and rows differ in the slashes after the scheme."""
    return F.regexp_replace(c, "^([A-Za-z0-9+.-]+:)/+", "$1/")


def schema_log(spark: SparkSession, out: str) -> DataFrame:
    """(epoch, columns, new_columns, rows): each set of columns a feed's files came with, in each epoch.

    ``new_columns`` are those that no earlier epoch had. Written by ``ingest_feed`` for every epoch, rewritten
    when an epoch is replayed."""
    log = spark.read.parquet(schema_log_path(out)).select("epoch", F.array_join("columns", ",").alias("columns"), "columns", _path_key("file").alias("_key")).toDF(
        "epoch", "header", "columns", "_key")
    read = spark.read.option("mergeSchema", "true").parquet(out).groupBy("epoch", _path_key("_file").alias("_key")).agg(F.count("*").alias("_n"))
    per = log.join(read, ["epoch", "_key"], "left").groupBy("epoch", "header").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.first("columns").alias("columns"))
    first = per.select("epoch", F.explode("columns").alias("c")).groupBy("c").agg(F.min("epoch").alias("_first"))
    new = per.select("epoch", "header", F.explode("columns").alias("c")).join(first, "c").filter(F.col("epoch") == F.col("_first"))
    new = new.groupBy("epoch", "header").agg(F.array_join(F.array_sort(F.collect_set("c")), ",").alias("new_columns"))
    return per.join(new, ["epoch", "header"], "left").select("epoch", F.col("header").alias("columns"), F.coalesce("new_columns", F.lit("")).alias("new_columns"), "rows")


# ---------------------------------------------------------------- retraction and two watermarks

def monthly_sales_apply(spark: SparkSession, root: str):
    """A ``foreachBatch`` function that keeps monthly sales right when a re-delivered row replaces its predecessor.

    An epoch logs the survivors it changes, by month, and the signed changes of the monthly sums: minus the old
    survivor, plus the new one. The old survivor is the least row of the epochs before, in the months of the
    batch only, so a replayed epoch writes the same again."""
    from ..operators.dedup import ranked
    from ..plans.silver import FACTS
    spec, cols = FACTS["sales"], feeds.FEED_COLUMNS["sales"]
    rest = [c for c in cols if c not in spec.keys]
    month = F.coalesce(F.substring("sale_date", 1, 7), F.lit("none"))

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        done = spec.finish(rows)
        return done.select(F.date_format("sale_date", "yyyy-MM").alias("month"), F.lit(sign).alias("units"),
                           (sign * cents("sale_amount")).alias("gross_c"), (sign * cents("net_revenue")).alias("net_c"))

    def written(rows: DataFrame, name: str, epoch: int) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{root}/{name}/epoch={epoch:06d}")
        return spark.read.schema(rows.schema).parquet(f"{root}/{name}/epoch={epoch:06d}")

    def same_key(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
        """Join on the business key, NULLs equal; a left join adds the other columns of ``other``."""
        added = [c for c in other.columns if c not in spec.keys]
        renamed = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(spec.keys)], *added)
        return rows.join(renamed, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(spec.keys)], how).drop(
            *[f"_k{i}" for i in range(len(spec.keys))])

    def apply(batch: DataFrame, epoch: int) -> None:
        new = dedup_first(spec.accept(batch.select(*cols)), spec.keys, spec.order(), spec.by).withColumn("_month", month)
        new.write.mode("overwrite").parquet(f"{root}/new/epoch={epoch:06d}")
        new = spark.read.schema(new.schema).parquet(f"{root}/new/epoch={epoch:06d}")
        months = [r["_month"] for r in new.select("_month").distinct().collect()]
        log = spark.read.schema(StructType([*new.schema, StructField("epoch", IntegerType())])).parquet(f"{root}/survivors") if epoch else None
        old = new.limit(0) if log is None else log.filter((F.col("epoch") < epoch) & F.col("_month").isin(months)).drop("epoch")
        # keys meet first, whole rows of the log only where their key came again
        # (both written, so that their sizes are known and few keys are broadcast)
        met = written(same_key(old.select(*spec.keys), new.select(*spec.keys), "left_semi").distinct(), "met", epoch)
        row = ranked(rest, spec.order())
        held = written(same_key(old, met, "left_semi").groupBy(*spec.keys).agg(F.min(row).alias("_o")), "held", epoch)
        best = same_key(new.select(*spec.keys, "_month", row.alias("_n")), held, "left")
        best = best.filter(F.col("_o").isNull() | (F.col("_n") < F.col("_o")))
        best.write.mode("overwrite").parquet(f"{root}/changes/epoch={epoch:06d}")
        best = spark.read.schema(best.schema).parquet(f"{root}/changes/epoch={epoch:06d}")
        side = lambda c, of: of.select(*spec.keys, "_month", *[F.col(c)[x].alias(x) for x in rest])
        won, lost = side("_n", best), side("_o", best.filter("_o IS NOT NULL"))
        won.select(*new.columns).write.mode("overwrite").partitionBy("_month").parquet(f"{root}/survivors/epoch={epoch:06d}")
        changes = signed(won, 1).unionByName(signed(lost, -1))
        sums = changes.groupBy("month").agg(*[F.sum(c).alias(c) for c in ("units", "gross_c", "net_c")])
        sums.write.mode("overwrite").parquet(f"{root}/sums/epoch={epoch:06d}")

    return apply


def monthly_sales(spark: SparkSession, root: str) -> DataFrame:
    """(month, units, gross_revenue, net_revenue): the changes of all epochs added up."""
    sums = spark.read.parquet(f"{root}/sums").groupBy("month").agg(*[F.sum(c).alias(c) for c in ("units", "gross_c", "net_c")])
    return sums.filter("units > 0").select("month", "units", from_cents("gross_c").alias("gross_revenue"), from_cents("net_c").alias("net_revenue"))


WATERMARK_POLICY = "min"               # a query with two watermarks follows the slower stream


def events_and_changes(spark: SparkSession, events: DataFrame, changes: DataFrame) -> DataFrame:
    """Events (three days late at most) and master rows (seven days) in one query, each once.

    ``events``: event_id, ts; ``changes``: master_id, changed_at, _row_hash. Under ``WATERMARK_POLICY`` both streams drop
    what is not later than the lesser watermark, so neither loses a row that its own delay allows."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", WATERMARK_POLICY)
    one = dedup_events(events).select(F.lit("event").alias("kind"), F.col("event_id").cast("string").alias("id"), "ts")
    master = changes.withColumn("event_time", F.col("changed_at").cast("timestamp"))
    two = master_changes(master, "master_id", "event_time").select(F.lit("master").alias("kind"), F.col("master_id").alias("id"), F.col("changed_at").alias("ts"))
    return one.unionByName(two)
