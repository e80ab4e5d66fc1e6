"""Dealers whose texts are few are broadcast to the sales, after the customers, and no sale is moved for them."""

import pytest

from motorlake.plans import catalog, silver
from motorlake.plans.catalog import Tables, held
from motorlake.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
BOUND = "spark.sql.autoBroadcastJoinThreshold"
VIN = "VN00000000000000{}"
RAW = [(VIN.format(1), "2024-01-02", "C1", "D1", "10.50", "1.00", "0.50", "ASIA", "online", "CARD", "A"),
       (VIN.format(1), "2024-01-03", None, "D9", "7.00", None, None, "ASIA", "online", "CARD", "A"),
       (VIN.format(2), "2024-01-03", "C9", None, "7.00", None, None, None, "online", None, "A"),
       (VIN.format(2), "2024-01-04", "C1", "D1", "7.00", None, None, None, "online", None, "A")]


@pytest.fixture()
def bound(spark):
    """Sets the planner's bound for broadcasts so low that nothing comes under it."""
    before = spark.conf.get(BOUND)
    spark.conf.set(BOUND, "1")
    yield
    spark.conf.set(BOUND, before)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("query", ["sales_enriched", "sales_performance"])
def test_no_sale_is_moved_for_its_dealer(spark, bound, query):
    made = executed(QUERIES[query](spark, SMALL))
    assert "BroadcastHashJoin [dealer_id" in made and "SortMergeJoin [dealer_id" not in made


def test_the_dealers_columns_are_not_moved_with_the_sales(spark, bound):
    joins = [line for line in plan(Tables(spark, SMALL).sales_enriched).splitlines() if "Join LeftOuter" in line]
    assert "dealer_id" in joins[0] and "broadcast" in joins[0] and "customer_id" in joins[1] and "vin" in joins[2]


def test_only_few_dealers_are_held(spark, bound, monkeypatch):
    t = Tables(spark, SMALL)
    feed = t.feed("dealer")
    size = sum(len("".join(v for v in r if v is not None).encode()) for r in feed.collect())
    monkeypatch.setattr(catalog, "HELD_BYTES", size)
    assert held(t.dealer_cur, feed) is not t.dealer_cur
    monkeypatch.setattr(catalog, "HELD_BYTES", size - 1)
    assert held(t.dealer_cur, feed) is t.dealer_cur
    monkeypatch.setattr(catalog, "HELD_BYTES", size)
    spark.conf.set(BOUND, "-1")                                         # switched off
    assert held(t.dealer_cur, feed) is t.dealer_cur
    spark.conf.set(BOUND, "1")
    none = feed.limit(0)
    assert held(none, none) is not none                                 # no rows


def test_both_orders_give_the_same_rows(spark):
    sales = silver.clean_sales(spark.createDataFrame(RAW, "vin string, sale_date string, customer_id string, dealer_id string, sale_amount string, discount string, "
                                                     "tax_amount string, region string, channel string, payment_mode string, city string"))
    customers = spark.createDataFrame([("C1", "n", "F", 3, "c", "s", "LOW", "h", "*")], "customer_id string, customer_name string, gender string, age int, city string, "
                                      "state string, income_range string, email_hash string, contact_number_masked string")
    dealers = spark.createDataFrame([("D1", "n", "OUTLET", "ASIA", "c", "s", 4.0)], "dealer_id string, dealer_name string, dealer_type string, region string, city string, "
                                    "state string, rating double")
    vehicles = spark.createDataFrame([(VIN.format(1), *"abcde", 2.0)], "vin string, model_code string, model_name string, fuel_type string, transmission string, "
                                     "variant string, ex_showroom_price double")
    first, last = (silver.sales_enriched(sales, customers, dealers, vehicles, after) for after in (False, True))
    assert first.columns == last.columns and rows(first) == rows(last) and last.count() == 4
