"""Mergeable exact distinct counts: dense ids and bitmaps.

A dictionary gives each value a dense id once; a state holds, per period, the ids seen as bitmaps of
32,768 ids. States of parts of the data add up by a bitwise or, so a month is the union of its days and a
new run only adds states. No row is multiplied: each counted column is one aggregation over its ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import run_dir

ROW = "_row"              # counted by every row, so periods whose values are all NULL stay


def extend_dictionary(values: DataFrame, known: DataFrame | None) -> DataFrame:
    """(value, id): ``known`` and an id from max + 1 on for each new non-NULL value (ids start at 1).

    ``values`` has one column ``value``. Ids follow the parts of the written distinct values; one row a part
    goes through the driver.
    """
    spark = values.sparkSession
    new = values.filter(F.col("value").isNotNull()).distinct()
    if known is not None:
        new = new.join(known, "value", "left_anti")
    path = run_dir(spark, "dictionary")
    new.withColumn("_at", F.monotonically_increasing_id()).write.parquet(f"{path}/new")
    rows = spark.read.schema(StructType([*new.schema, StructField("_at", LongType())])).parquet(f"{path}/new")
    rows = rows.select("value", F.shiftright("_at", 33).cast("int").alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    before = 1 + ((known.agg(F.max("id")).first()[0] or 0) if known is not None else 0)
    offsets = []
    for part, n in sorted((r["_part"], r["count"]) for r in rows.groupBy("_part").count().collect()):
        offsets.append((part, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(offsets, "_part int, _before long"))
    out = rows.join(offsets, "_part").select("value", (F.col("_before") + F.col("_at")).alias("id"))
    out = out if known is None else known.unionByName(out)
    out.write.parquet(f"{path}/ids")
    return spark.read.schema(out.schema).parquet(f"{path}/ids")


def encode(facts: DataFrame, columns: Sequence[str], dictionaries: dict[str, DataFrame]) -> DataFrame:
    """``facts`` with each of ``columns`` replaced by its id; NULL stays NULL. The dictionaries are written
    tables, so a join may split a value that holds many rows."""
    for c in columns:
        ids = dictionaries[c].select(F.col("value").alias(c), F.col("id").alias(f"_{c}"))
        facts = facts.join(ids, c, "left").drop(c).withColumnRenamed(f"_{c}", c)
    return facts


def states(encoded: DataFrame, period: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(period, counted, bucket, bits) of encoded facts; read from a written table, each column's pass reads its
    ids and the period only."""
    out = None
    for c in [*columns, ROW]:
        i = F.lit(1).cast("long") if c == ROW else F.col(c)
        part = (encoded.filter(i.isNotNull()).groupBy(*period, F.bitmap_bucket_number(i).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(i)).alias("bits"))
                .select(*period, F.lit(c).alias("counted"), "bucket", "bits"))
        out = part if out is None else out.unionByName(part)
    return out


def counts(merged: DataFrame, by: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Distinct counts per ``by`` (functions of the period) from any union of states; ``columns``: column -> result name."""
    one = merged.groupBy(*by, "counted", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_n"))
    n = [F.coalesce(F.sum(F.when(F.col("counted") == c, F.col("_n"))), F.lit(0)).alias(name) for c, name in columns.items()]
    return one.groupBy(*by).agg(*n)
