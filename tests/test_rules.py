"""Literal cases for the cleansing, masking, hashing and labelling rules."""

import datetime as dt

from pyspark.sql import functions as F

from motorlake.functions import cleanse
from motorlake.functions.exact import div_half_up, round_half_up
from motorlake.operators.hashing import row_hash
from motorlake.plans.report import pct_label


def col(spark, values, t="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {t}")


def test_vin_rule(spark):
    vins = ["1HGCM82633A004352", "1HGCM82633A00435", "1HGCM82633A0043522", "1HGCM82633A00435I",
            "1HGCM82633A00435O", "1HGCM82633A00435Q", "1hgcm82633a004352", "1HGCM82633A00435\n", None]
    got = [r[0] for r in col(spark, vins).select(cleanse.valid_vin("x")).collect()]
    assert [bool(g) for g in got] == [True] + [False] * 8


def test_phone_mask(spark):
    got = [r[0] for r in col(spark, ["9876543210", "+91-98765-43210", "123", None]).select(
        cleanse.mask_phone("x")).collect()]
    assert got == ["******3210", "+91-*8765-*3210", "123", None]
    strict = col(spark, ["+91-98765-43210"]).select(cleanse.mask_last4("x")).first()[0]
    assert strict == "+**-*****-*3210"


def test_email_hash(spark):
    assert col(spark, ["a@b.c"]).select(cleanse.hash_pii("x")).first()[0] == \
        "d648b243a3e817eaa3309e00e183483f2867baadf522099f0c2121770536b25a"


def test_safe_casts(spark):
    got = [r[0] for r in col(spark, ["x", "12.7", " 12 "]).select(F.col("x").try_cast("int")).collect()]
    assert got == [None, None, 12]
    dates = [r[0] for r in col(spark, ["bad", "31/12/2024", "2024-12-31"]).select(cleanse.safe_date("x")).collect()]
    assert dates == [None, None, dt.date(2024, 12, 31)]


def test_rating_range(spark):
    got = [r[0] for r in col(spark, [0, 1, 5, 6, None], "int").select(cleanse.null_outside("x", 1, 5)).collect()]
    assert got == [None, 1, 5, None, None]


def test_quarter_label(spark):
    got = [r[0] for r in col(spark, [dt.date(2024, 9, 30), None], "date").select(cleanse.quarter_label("x")).collect()]
    assert got == ["2024Q3", ""]


def test_row_hash_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "p string, q string")
    plain = [r[0] for r in df.select(row_hash(["p", "q"])).collect()]
    safe = [r[0] for r in df.select(row_hash(["p", "q"], null_safe=True)).collect()]
    assert plain[0] == plain[1]
    assert safe[0] != safe[1]


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(1005, 1000), (-1005, 1000), (1, 3), (2, 3), (5, 0)], "n long, d long")
    got = [r[0] for r in df.select(div_half_up("n", "d")).collect()]
    assert got == [1, -1, 0, 1, None]
    z = [r[0] for r in col(spark, [2.004, -2.005, 1.7888], "double").select(round_half_up("x", 2)).collect()]
    assert z[0] == 2.0 and z[2] == 1.79


def test_pct_labels(spark):
    df = spark.createDataFrame([(110.0, 100.0), (90.0, 100.0), (100.0, 100.0), (5.0, 0.0), (5.0, None)],
                               "t double, y double")
    got = [r[0] for r in df.select(pct_label("t", "y")).collect()]
    assert got == ["▲ 10.0%", "▼ 10.0%", "─ 0.0%", "N/A (no prior data)", "N/A (no prior data)"]


def test_text_scrub(spark):
    import hashlib

    from motorlake.functions.text import scrub_text
    df = spark.createDataFrame([(1, "mail a@b.com or 9876543210, not 12345, card 4111111111111111, +91-98765-43210"), (2, None)], "doc_id int, text string")
    r, null = scrub_text(df).orderBy("doc_id").collect()
    digest = hashlib.sha256(b"a@b.com").hexdigest()
    assert (r.n_emails, r.n_phones, r.email_hashes) == (1, 2, digest)
    assert r.scrubbed_text == f"mail {digest} or ******3210, not 12345, card 4111111111111111, ******3210"
    assert null.scrubbed_text is None
