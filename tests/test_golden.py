"""Small end-to-end scenarios with exact expected rows."""

from pyspark.sql import functions as F

from plumbline.operators.aggregate import nested_counts
from plumbline.operators.coverage import area_coverage
from plumbline.operators.quality import classify_portfolio
from plumbline.operators.sequence import global_row_number

from .conftest import rows

OFFERS = "shop_id string, shop string, item string, town string, season string, shelf string"
OFFER_ROWS = [
    ("s7", "North Mill", "rye", "Hafen", "spring", "left"),
    ("s9", "Old Wharf", "rye", "Brück", "spring", "left"),
    ("s9", "Old Wharf", "oat", "Brück", "autumn", "right"),
    ("s9", "Old Wharf", "oat", "Brück", "autumn", "left"),
    ("s4", "Hill Barn", "oat", "Moor", "autumn", "right"),
]


def test_coverage_by_area(frame):
    offers = frame(OFFERS, *OFFER_ROWS)
    all_shops = frame("shop_id string", ("s4",), ("s7",), ("s9",))
    two = frame("shop_id string", ("s7",), ("s9",))
    found = area_coverage(offers, "shop_id", {"address": all_shops, "owner": two, "prices": None}, {"address": 1.0, "owner": 0.9, "prices": 0.1})
    assert rows(found, "area", "covered_count", "missing_count", "area_status", "blocker_code") == [
        ("address", 3, 0, "passed", ""),
        ("owner", 2, 1, "below_threshold", "OWNER_COVERAGE_BELOW_THRESHOLD"),
        ("prices", 0, 3, "missing_table", "PRICES_COVERAGE_MISSING_TABLE"),
    ]


def test_missing_list_is_ranked(frame):
    summary = frame(OFFERS, *OFFER_ROWS).groupBy("shop_id").agg(F.count(F.lit(1)).alias("offers"), F.count_distinct("item").alias("items"))
    ranked = global_row_number(summary, [F.desc("offers"), F.desc("items"), F.asc("shop_id")], "rank")
    assert rows(ranked, "rank", "offers", "items", "shop_id") == [(1, 3, 2, "s9"), (2, 1, 1, "s4"), (3, 1, 1, "s7")]


def test_portfolio_buckets(frame):
    domains = frame(
        "domain string, area string, declared string, importance string",
        ("low", "x", "easy_but_underused", "required"),
        ("full", "z", "required_unavailable", "required"),
        ("unmeasured", "none", "required_unavailable", "required"),
        ("extra", "z", "easy_but_underused", "optional"),
        ("odd", "none", "planned", "optional"),
    )
    coverage = frame("area string, coverage_rate double, area_status string", ("x", 0.2, "below_threshold"), ("z", 1.0, "passed"))
    assert rows(classify_portfolio(domains, coverage, "area"), "domain", "bucket", "blocker_code") == [
        ("extra", "easy_but_underused", ""),
        ("full", "required_available", ""),
        ("low", "required_unavailable", "LOW_NOT_OPERATIONAL"),
        ("odd", "optional_enhancement", ""),
        ("unmeasured", "required_unavailable", "UNMEASURED_NOT_OPERATIONAL"),
    ]


def test_missing_by_type(frame):
    pending = frame("kind string, code string, metric string", ("art", "1", "m1"), ("art", "1", "m2"), ("art", "2", "m1"), ("tech", "3", "m1"))
    assert rows(nested_counts(pending, ["kind"], "code", "metric"), "kind", "missing_rows", "metric_counts", "entity_count") == [
        ("art", 3, "m1:2|m2:1", 2),
        ("tech", 1, "m1:1", 1),
    ]
