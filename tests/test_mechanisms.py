"""Bitmap distinct counts, as-of by merge, headers and schema log, retraction, scrubbing by position."""

import hashlib
import random

from pyspark.sql import functions as F

from motorlake.functions.text import scrub_text
from motorlake.operators import distinct, quality, scd2
from motorlake.session import run_dir
from motorlake.sources import feeds
from motorlake.streaming import ingest


def saved(df, tag):
    path = run_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def test_bitmaps_of_two_runs_add_up(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "2020-01-01", "2020-01-02", "2020-02-01"]), rng.choice([None, *map(str, range(70_000))]), rng.choice(["x", "y", None]))
            for _ in range(3000)] + [("2020-03-01", None, None)] + [("2020-04-01", str(i), "hot") for i in range(40_000)]
    df = spark.createDataFrame(rows, "day string, a string, b string")
    known, states = {}, None
    for part in (df.filter("a < '5' or a is null"), df.filter("a >= '5'")):
        known = {c: distinct.extend_dictionary(part.select(F.col(c).alias("value")), known.get(c)) for c in ("a", "b")}
        one = saved(distinct.states(saved(distinct.encode(part, ["a", "b"], known), "enc"), ["day"], ["a", "b"]), "states")
        states = one if states is None else states.unionByName(one)
    ids = known["a"].agg(F.min("id"), F.max("id"), F.count("*"), F.count_distinct("id"), F.count_distinct("value")).first()
    assert ids[0] == 1 and ids[1] == ids[2] == ids[3] == ids[4] > 32768
    got = distinct.counts(states.withColumn("m", F.substring("day", 1, 7)), ["m"], {"a": "na", "b": "nb"})
    want = df.groupBy(F.substring("day", 1, 7).alias("m")).agg(F.count_distinct("a").alias("na"), F.count_distinct("b").alias("nb"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    for plan in (got, distinct.states(distinct.encode(df, ["a", "b"], known), ["day"], ["a", "b"])):
        assert "Expand" not in plan._jdf.queryExecution().toString()


def test_asof_merge_equals_join_with_many_versions(spark):
    rng = random.Random(2)
    day = lambda n: f"{2000 + n // 336}-{n // 28 % 12 + 1:02d}-{n % 28 + 1:02d}"
    starts = [(f"2001-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}" if i < 3600 else f"{day(i - 3000)} 00:00:00") for i in range(0, 10_000)]
    starts = sorted(set(starts))
    versions = [("k", s, starts[i + 1] if i + 1 < len(starts) else None, i, f"n{i}") for i, s in enumerate(starts)]
    versions += [("closed", "2002-01-05 00:00:00", "2002-03-01 00:00:00", 1, "c"), (None, "2002-01-01 00:00:00", None, 2, "none")]
    history = spark.createDataFrame(versions, "k string, s string, e string, rating int, name string").select(
        "k", F.col("s").cast("timestamp_ntz").alias("scd_start_date"), F.col("e").cast("timestamp_ntz").alias("scd_end_date"), "rating", "name")
    facts = [(i, rng.choice(["k", "k", "closed", "unknown", None]), rng.choice([None, *[day(rng.randint(0, 9000)) for _ in range(9)], "2001-01-01", "2002-03-01"]), "x")
             for i in range(3000)] + [(5000 + i, "k", "2003-02-02", "x") for i in range(50)]
    facts = spark.createDataFrame(facts, "_t int, k string, d string, _v string").withColumn("d", F.to_date("d"))
    want = scd2.asof_join(facts, history, "k", "d", ["rating", "name"])
    for span in ("month", "day", "year"):
        got = scd2.asof_merge(facts, history, "k", "d", ["rating", "name"], span)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_headers_and_schema_log(spark):
    root = run_dir(spark, "headers")
    rows = spark.createDataFrame([("P1", "D1", "5", "2020-01-01")], "part_id string, dealer_id string, available_stock string, last_restock_date string")
    ingest.write_csv(rows.coalesce(1), f"{root}/in/a")
    ingest.write_csv(rows.select("dealer_id", "part_id").coalesce(1), f"{root}/in/b")
    files = feeds.list_files(spark, f"{root}/in/*")
    assert sorted(feeds.header_columns(spark, files).values()) == [("dealer_id", "part_id"), ("part_id", "dealer_id", "available_stock", "last_restock_date")]
    assert len(feeds.read_feed(spark, f"{root}/in/*", "dealer_parts").collect()) == 2
    ingest.ingest_feed(spark, f"{root}/in/*", f"{root}/out", f"{root}/ckpt", "dealer_parts")
    ingest.write_csv(rows.withColumn("bin", F.lit("x")).coalesce(1), f"{root}/in/c")
    ingest.ingest_feed(spark, f"{root}/in/*", f"{root}/out", f"{root}/ckpt", "dealer_parts")
    log = sorted(map(tuple, ingest.schema_log(spark, f"{root}/out").collect()))
    assert [(e, c, n) for e, c, _, n in log] == [(0, "dealer_id,part_id", 1), (0, "part_id,dealer_id,available_stock,last_restock_date", 1),
                                                 (1, "part_id,dealer_id,available_stock,last_restock_date,bin", 1)]
    assert log[2][2] == "bin"


def sales(spark, rows):
    return spark.createDataFrame([(v, d, "C1", "D1", a, None, "1.0", "r", "c", "p", "x") for v, d, a in rows],
                                 ", ".join(f"{c} string" for c in feeds.FEED_COLUMNS["sales"]))


def test_retraction_and_replay(spark):
    root = run_dir(spark, "retract")
    apply = ingest.monthly_sales_apply(spark, root)
    v = "VN" + "0" * 14
    apply(sales(spark, [(v + "1", "2020-01-05", "10.0"), (v + "2", "2020-01-06", "7.5"), (v + "3", "2020-02-01", "3.0"), (v + "4", "bad", "2.0")]), 0)
    read = lambda: sorted(((r.month, r.units, r.gross_revenue) for r in ingest.monthly_sales(spark, root).collect()), key=repr)
    assert read() == sorted([("2020-01", 2, 17.5), ("2020-02", 1, 3.0), (None, 1, 2.0)], key=repr)
    better = sales(spark, [(v + "1", "2020-01-05", "4.0"), (v + "2", "2020-01-06", "9.0"), (v + "5", "2020-02-02", "1.0")])
    for _ in range(2):          # the second time as a replay
        apply(better, 1)
        assert read() == sorted([("2020-01", 2, 11.5), ("2020-02", 2, 4.0), (None, 1, 2.0)], key=repr)
    apply(sales(spark, [(v + "1", "2020-01-05", "10.0")]), 2)      # the old row comes again and loses
    assert read()[0] == ("2020-01", 2, 11.5)


def test_scrub_by_position(spark):
    h = lambda e: hashlib.sha256(e.encode()).hexdigest()
    texts = ["a@b.co then xa@b.co and a@b.com.", "a@b.co", "no address", "", None, "a@b.co a@b.co9", "tel 123456 7890 or 1234567890 a@b.co"]
    got = [r.scrubbed_text for r in scrub_text(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got[0] == f"{h('a@b.co')} then {h('xa@b.co')} and {h('a@b.com')}."
    assert got[1:5] == [h("a@b.co"), "no address", "", None]
    assert got[5] == f"{h('a@b.co')} {h('a@b.co')}9"
    assert got[6].endswith(h("a@b.co")) and "******7890" in got[6]


def test_checked_write_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(None if i % 5 == 0 else "V", str(i - 3)) for i in range(40)], "vin string, claim_amount string").mapInArrow(
        count, "vin string, claim_amount string")
    checked = quality.Checked(rows, "warranty", run_dir(spark, "checked"))
    got = checked.write(quality.fact_rules()["warranty"])
    assert got == [("warranty", "vin_not_null", 40, 32, 8), ("warranty", "valid_claim_amount", 40, 37, 3)]
    assert checked.kept().count() == 30 and checked.quarantined().count() == 10 and seen.value == 40
    assert {r.reasons for r in checked.quarantined().collect()} == {"vin_not_null", "valid_claim_amount", "vin_not_null,valid_claim_amount"}
    none = quality.Checked(rows.limit(0), "warranty", run_dir(spark, "checked"))
    assert none.write(quality.fact_rules()["warranty"])[0][2:] == (0, 0, 0) and none.rows().count() == 0
