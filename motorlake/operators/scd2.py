"""Slowly changing dimension, type 2.

``scd2_apply`` merges one snapshot into a history with one ``as_of`` time: one full outer join of the
current versions and the snapshot closes changed versions and opens new ones; closed history
passes by untouched. ``VersionedHistory`` keeps a history on storage: every run writes the current
rows and the rows it closed to a folder of its own and commits it last, so a run can be
repeated, nothing is overwritten while it is read, and closed rows are written once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType, TimestampNTZType

from .dedup import dedup_first

SCD_COLS = ["_ingest_ts", "scd_start_date", "scd_end_date", "is_current"]


def _ts(as_of) -> Column:
    """Version times are wall-clock-free TIMESTAMP_NTZ values given by the caller."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def empty_history(spark: SparkSession, snapshot: DataFrame) -> DataFrame:
    """A typed empty history for a snapshot schema (CREATE TABLE IF NOT EXISTS)."""
    fields = list(snapshot.schema.fields) + [
        StructField("_ingest_ts", TimestampNTZType(), True),
        StructField("scd_start_date", TimestampNTZType(), True),
        StructField("scd_end_date", TimestampNTZType(), True),
        StructField("is_current", BooleanType(), True),
    ]
    return spark.createDataFrame([], StructType(fields))


def changed_rows(snapshot: DataFrame, history: DataFrame, key: str, hash_col: str = "_row_hash") -> DataFrame:
    """Snapshot rows whose (key, hash) is not a current version: new or changed."""
    cur = history.filter(F.col("is_current")).select(key, hash_col)
    return snapshot.join(cur, [key, hash_col], "left_anti")


def merge_current(current: DataFrame, snapshot: DataFrame, key: str, as_of, hash_col: str = "_row_hash",
                  close_missing: bool = False) -> DataFrame:
    """The rows of ``current`` after a snapshot: kept or closed, and the versions it opens."""
    ts = _ts(as_of)
    attrs = list(snapshot.columns)
    src = dedup_first(snapshot, [key])  # one row per key: duplicate keys cannot open two versions
    c = current.select(F.col(key).alias("_ck"), F.struct(*attrs, *SCD_COLS).alias("_c"))
    s = src.select(F.col(key).alias("_sk"), F.struct(*attrs).alias("_s"))
    old, new = F.col("_c"), F.col("_s")
    differs = F.coalesce(old[hash_col] != new[hash_col], F.lit(True))
    closes = old.isNotNull() & F.when(new.isNotNull(), differs).otherwise(F.lit(close_missing))
    opens = new.isNotNull() & (old.isNull() | differs)
    kept = F.struct(*(old[a].alias(a) for a in attrs), old["_ingest_ts"].alias("_ingest_ts"),
                    old["scd_start_date"].alias("scd_start_date"),
                    F.when(closes, ts).otherwise(old["scd_end_date"]).alias("scd_end_date"), (~closes).alias("is_current"))
    opened = F.struct(*(new[a].alias(a) for a in attrs), ts.alias("_ingest_ts"), ts.alias("scd_start_date"),
                      F.lit(None).cast("timestamp_ntz").alias("scd_end_date"), F.lit(True).alias("is_current"))
    rows = F.array_compact(F.array(F.when(old.isNotNull(), kept), F.when(opens, opened)))
    return c.join(s, F.col("_ck") == F.col("_sk"), "full").select(F.explode(rows).alias("_r")).select("_r.*")


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, as_of, hash_col: str = "_row_hash",
               close_missing: bool = False) -> DataFrame:
    cols = [*snapshot.columns, *SCD_COLS]
    merged = merge_current(history.filter(F.col("is_current")), snapshot, key, as_of, hash_col, close_missing)
    return history.filter(~F.col("is_current")).select(*cols).unionByName(merged.select(*cols))


class VersionedHistory:
    """An SCD2 history under ``root``: data/v=<n>/is_current=<b> folders and a table of commits.

    The history of version n is the current rows of n and the closed rows of all committed
    versions up to n. A folder without a commit is ignored and rewritten by the next run.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> list[tuple[int, str]]:
        try:
            rows = self.spark.read.schema("v int, as_of string").parquet(f"{self.root}/commits").distinct().collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        return sorted((r["v"], r["as_of"]) for r in rows)

    def latest(self, below: int | None = None) -> int | None:
        """The highest committed version (below a given one), None without any."""
        found = [v for v, _ in self.commits() if below is None or v < below]
        return max(found, default=None)

    def read(self, version: int | None = None) -> DataFrame | None:
        version = self.latest() if version is None else version
        if version is None:
            return None
        committed = [v for v, _ in self.commits() if v <= version]
        rows = self.spark.read.parquet(f"{self.root}/data").withColumn("is_current", F.col("is_current").cast("boolean"))
        mine = (F.col("v") == version) | (~F.col("is_current") & F.col("v").isin(committed))
        return rows.filter(mine).drop("v")

    def write(self, version: int, rows: DataFrame, as_of: str) -> None:
        """Write a version's current and newly closed rows, then commit it."""
        if version in [v for v, _ in self.commits()] and self.latest() != version:
            raise ValueError(f"version {version} of {self.root} has successors")
        rows.write.mode("overwrite").partitionBy("is_current").parquet(f"{self.root}/data/v={version:06d}")
        self.spark.createDataFrame([(version, str(as_of))], "v int, as_of string").coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def merge(self, snapshot: DataFrame, key: str, as_of, **options) -> DataFrame:
        """Merge a snapshot into the latest version and commit the result as the next one."""
        done = self.commits()
        if done and str(as_of) < max(t for _, t in done):
            raise ValueError(f"as_of {as_of} lies before the latest commit of {self.root}")
        last = self.latest()
        history = self.read(last) if last is not None else empty_history(self.spark, snapshot)
        version = (last or 0) + 1
        self.write(version, merge_current(history.filter(F.col("is_current")), snapshot, key, as_of, **options), as_of)
        return self.read(version)


def current_view(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current"))


def scd2_from_log(log: DataFrame, key: str, ts_col: str, hash_col: str = "_row_hash") -> DataFrame:
    """Versions from an ordered change log in one pass.

    A row opens a version when its hash differs from the key's previous
    logged hash; the version ends where the key's next version starts.
    """
    w = Window.partitionBy(key).orderBy(ts_col)
    opened = (log.withColumn("_prev", F.lag(hash_col).over(w))
                 .filter(F.col("_prev").isNull() | (F.col("_prev") != F.col(hash_col)))
                 .drop("_prev"))
    return (opened.withColumns({
        "scd_start_date": F.col(ts_col).cast("timestamp_ntz"),
        "scd_end_date": F.lead(F.col(ts_col).cast("timestamp_ntz")).over(w),
    }).withColumn("is_current", F.col("scd_end_date").isNull()))


def asof_join(facts: DataFrame, history: DataFrame, key: str, fact_time: str,
              columns: Sequence[str]) -> DataFrame:
    """Attach the dimension version valid at the fact time (start <= t < end).

    An equi-join on the key with a range condition: each fact row meets the
    versions of its own key only, so the work is facts x versions-per-key.
    """
    h = history.select(F.col(key).alias("_hk"), "scd_start_date", "scd_end_date",
                       *[F.col(c).alias(c) for c in columns])
    t = F.col(fact_time).cast("timestamp_ntz")
    cond = ((F.col(key) == F.col("_hk")) & (F.col("scd_start_date") <= t)
            & (F.col("scd_end_date").isNull() | (t < F.col("scd_end_date"))))
    return facts.join(h, cond, "left").drop("_hk", "scd_start_date", "scd_end_date")


def asof_merge(facts: DataFrame, history: DataFrame, key: str, fact_time: str, columns: Sequence[str], span: str = "month") -> DataFrame:
    """As ``asof_join``, by a merge: facts and versions of a key in time order, the last version carried forward.

    A key's time is cut into spans, so a key with many facts is many groups; each (key, span) that has facts
    is handed the last version before it. A fact costs one row, however many versions its key has. Facts
    without key or time get NULLs, as does a time after a version that closed without a successor.
    """
    kind, at = history.schema[key].dataType.simpleString(), F.col(fact_time).cast("timestamp_ntz")
    version = F.struct(F.col("scd_end_date").alias("_end"), *[F.col(c).alias(c) for c in columns])
    none = F.lit(None).cast(history.select(version.alias("_v")).schema["_v"].dataType)
    same = {key} if facts.schema[key].dataType == history.schema[key].dataType else set()      # moved once, as ``_k``
    carried = [c for c in facts.columns if c not in same] or facts.columns
    whole = F.struct(*[F.col(c) for c in carried])
    empty = F.lit(None).cast(facts.select(whole.alias("_f")).schema["_f"].dataType)
    cut = lambda t: F.date_trunc(span, t).cast("timestamp_ntz")
    usable = F.col(key).isNotNull() & at.isNotNull()
    asked = facts.filter(usable).select(F.col(key).cast(kind).alias("_k"), cut(at).alias("_span"), at.alias("_t"), F.lit(2).alias("_kind"),
                                        whole.alias("_f"), none.alias("_v"))
    start = F.col("scd_start_date")
    versions = history.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"), cut(start).alias("_span"), start.alias("_t"), F.lit(1).alias("_kind"),
                                                             empty.alias("_f"), version.alias("_v"))
    # what each span is handed: spans and versions of a key in order, before any fact
    marks = asked.select("_k", "_span").distinct().select("_k", "_span", F.col("_span").alias("_t"), F.lit(0).alias("_kind"), none.alias("_v"))
    in_order = Window.partitionBy("_k").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    handed = marks.unionByName(versions.drop("_f")).withColumn("_v", F.last("_v", ignorenulls=True).over(in_order)).filter("_kind = 0")
    rows = asked.unionByName(versions).unionByName(handed.withColumn("_f", empty))
    within = Window.partitionBy("_k", "_span").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.withColumn("_v", F.last("_v", ignorenulls=True).over(within)).filter("_kind = 2")
    valid = F.col("_v._end").isNull() | (F.col("_t") < F.col("_v._end"))
    out = met.select(*[F.col("_f")[c].alias(c) if c in carried else F.col("_k").alias(c) for c in facts.columns], *[F.when(valid, F.col("_v")[c]).alias(c) for c in columns])
    left = facts.filter(~usable).select("*", *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in columns])
    return out.unionByName(left)
