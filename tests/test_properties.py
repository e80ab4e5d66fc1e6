"""Properties from the test strategy: row accounting, grain kept by N:1 joins,
rollups sum to detail, score bounds."""

from pyspark.sql import functions as F

from conftest import SMALL
from motorlake.operators import quality
from motorlake.plans import kpi
from motorlake.plans.catalog import Tables


def test_sales_rows_accounted(spark):
    t = Tables(spark, SMALL)
    feed = t.feed("sales")
    quarantined = quality.quarantine(feed, quality.sales_rules()).count()
    passing = feed.count() - quarantined
    clean = t.sales.count()
    passing_keys = (feed.filter(F.col("vin").isNotNull()
                                & (F.col("sale_amount").try_cast("double") > 0))
                    .filter(F.length("vin") == 17)
                    .filter(F.regexp_extract("vin", r"^[A-HJ-NPR-Z0-9]{17}$", 0) != "")
                    .select("vin", "sale_date").distinct().count())
    assert clean == passing_keys
    assert feed.count() == clean + quarantined + (passing - clean)


def test_n_to_1_enrichment_keeps_grain(spark):
    t = Tables(spark, SMALL)
    assert t.sales_enriched.count() == t.sales.count()
    assert t.service_enriched.count() == t.service.count()
    assert t.warranty_enriched.count() == t.warranty.count()
    assert t.inventory_enriched.count() == t.inventory.count()
    assert t.production_enriched.count() == t.production.count()


def test_rollup_sums_equal_detail(spark):
    t = Tables(spark, SMALL)
    detail = kpi.sales_performance(t.sales_enriched).agg(
        F.sum("gross_revenue"), F.sum("total_discount")).first()
    roll = kpi.sales_performance_rollup(t.sales_enriched).agg(
        F.sum("gross_revenue"), F.sum("total_discount")).first()
    assert round(detail[0], 2) == round(roll[0], 2) and round(detail[1], 2) == round(roll[1], 2)
    p = kpi.production_efficiency(t.production_enriched).agg(F.sum("total_units")).first()[0]
    pr = kpi.production_efficiency_rollup(t.production_enriched).agg(F.sum("total_units")).first()[0]
    assert p == pr == t.production.count()


def test_score_within_bounds(spark):
    t = Tables(spark, SMALL)
    sc = kpi.dealer_scorecard(t.sales_enriched, t.service_enriched, t.warranty_enriched, t.inventory_enriched,
                              t.dealer_parts)
    r = sc.agg(F.min("composite_score"), F.max("composite_score")).first()
    assert 0 <= r[0] <= r[1] <= 100
