"""Facts of a span, and the pairs and years of all facts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from demandspark.plans import queries as Q
from demandspark.sources.testdata import TestData

START, END = date(1997, 9, 1), date(2000, 6, 30)
#: Order, part, supplier and day; orders 1 to 40, parts 1 to 3 and suppliers 1 to 3 exist.
INSIDE = [(i, 1, 1, datetime(1999, 1, 1 + i)) for i in range(1, 9)]
LINES = {
    "inside": INSIDE,
    "none": [],
    "a pair outside": [*INSIDE, (9, 2, 2, datetime(1999, 1, 1)), (10, 3, 1, datetime(1996, 5, 5))],
    "years outside": [*INSIDE, (11, 1, 1, datetime(1993, 5, 5)), (12, 1, 1, datetime(2003, 5, 5))],
    "only outside": [(11, 1, 1, datetime(1993, 5, 5)), (12, 2, 1, datetime(2003, 5, 5))],
    "without an order or a part": [*INSIDE, (99, 2, 2, datetime(1980, 1, 1)), (13, 9, 1, datetime(2020, 1, 1)), (None, 3, 3, datetime(2020, 1, 1))],
    "nulls": [*INSIDE, (14, 2, 2, None), (15, 3, 3, datetime(1994, 1, 1)), (16, 1, 3, None), (17, 1, None, datetime(2020, 1, 1))],
    "twice": [*INSIDE, *[(18, 2, 2, datetime(1990, 1, 1))] * 3],
}


@pytest.fixture(params=LINES)
def data(spark, tmp_path, request):
    rows = [(o, p, s, 1 + k % 4, float(k), 10.4 * k, d) for k, (o, p, s, d) in enumerate(LINES[request.param])]
    tables = {
        "lineitem": (rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"),
        "orders": ([(i, i % 7) for i in range(1, 41)] + [(18, 3)], "o_orderkey long, o_custkey long"),
        "part": ([(1, "Brand#11"), (2, "Brand#12"), (3, None)], "p_partkey long, p_brand string"),
        "supplier": ([(1, 4), (2, 5), (3, None)], "s_suppkey long, s_nationkey int"),
    }
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return TestData(spark, str(tmp_path))


def seen(df):
    pairs = {(r.yj_code, r.store_code) for r in df.select("yj_code", "store_code").collect()}
    return pairs, tuple(df.agg(F.year(F.min("dispensing_date")), F.year(F.max("dispensing_date"))).first())


def test_stock_has_all_pairs_and_years(data):
    assert seen(data.stock(START, END)) == seen(data.rx)


def test_facts_of_a_span(data):
    inside = data.rx.where(F.col("dispensing_date").between(START, END))
    got = data.between(START, END)
    assert got.columns == inside.columns and got.exceptAll(inside).isEmpty() and inside.exceptAll(got).isEmpty()


def test_a_flow_writes_only_facts_of_its_span(spark, smoke):
    c = Q.context(spark, smoke)
    days = c.facts.agg(F.min("dispensing_date"), F.max("dispensing_date")).first()
    assert c.cfg.panel_start <= days[0] and days[1] <= c.cfg.end
    assert c.facts.count() < c.data.rx.count()
    again = Q.context(spark, smoke, Q.CHECK.with_(sample_rate=7))
    assert again.facts is c.facts and again.stock is c.stock
    assert seen(c.stock) == seen(c.data.rx)
