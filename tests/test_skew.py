"""A key holding a third of all rows: results stay exact and the plan combines map-side."""

from pyspark.sql import functions as F

from motorlake.operators.dedup import dedup_first
from motorlake.operators import zscore


def test_hot_key_dedup_and_partial_aggregation(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        (F.col("id") % 1000).alias("amount"), F.col("id").alias("seq")).repartition(8)
    out = dedup_first(df, ["k"], ["amount", "seq"])
    assert out.count() == 1 + (n - n // 3)
    hot = out.filter("k = 'HOT'").first()
    assert (hot.amount, hot.seq) == (0, 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # duplicates collapse before the shuffle


def test_hot_entity_baseline_is_pre_aggregated(spark):
    # a hot dealer's rows are reduced to one per day before the rolling window
    rows = spark.range(0, 60 * 200).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 200).cast("int")).alias("day"),
        F.lit(10).alias("x"))
    daily = rows.groupBy(F.lit("HOT").alias("dealer_id"), "day").agg(F.sum("x").alias("v"))
    z = zscore.rolling_zscore(daily, ["dealer_id"], "day", "v")
    assert z.count() == 60 and z.filter("anomaly_flag = 1").count() == 0


def test_a_hot_vin_is_split_in_the_visit_join(spark):
    """A third of the visits on one vin, the multiplicities written: the skewed partition is split."""
    from motorlake.plans import silver
    from motorlake.session import run_dir
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        vin = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("V"), (F.col("id") % 5000).cast("string")))
        visits = spark.range(200_000).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("service_id"), vin.alias("vin"))
        claims = spark.range(50_000).select(F.col("id").cast("string").alias("claim_id"), vin.alias("vin"))
        path = run_dir(spark, "claims-per-vin")
        silver.claims_per_vin(claims).write.parquet(path)
        joined = visits.join(spark.read.parquet(path), "vin", "left")
        assert joined.count() == 200_000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
