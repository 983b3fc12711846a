"""The derived source tables keep the same share of rows at every size."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import eduviews as E
from tessera.plans import views as V
from tessera.plans.registry import QUERIES, Tables, load_all

SIZES = ["sf0.001", "sf0.01", "sf0.1"]


@pytest.mark.parametrize("size", SIZES)
def test_schools_and_enrolments_keep_their_share(spark, size):
    load_all()
    base = f"/root/testdata/{size}"
    t = Tables(spark, base)
    schools = t.supplier.count()
    assert QUERIES["mart_schools_flat"](spark, base).count() >= 0.8 * schools
    orders = E.enrolments(t.orders, t.lineitem)
    assert orders.count() == t.orders.count()
    with_lines = t.lineitem.select("l_orderkey").distinct().count()
    assert orders.where("school_id is not null").count() == with_lines


@pytest.mark.parametrize("size", SIZES[:2])
def test_snapshots_have_one_row_per_key(spark, size):
    customer = Tables(spark, f"/root/testdata/{size}").customer
    far = customer.select((F.col("c_custkey") + 1_000_000).alias("c_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    for table in (customer, customer.select(far.columns).union(far)):
        snap = V.customer_day3(table)
        assert snap.count() == snap.select("c_custkey").distinct().count()
