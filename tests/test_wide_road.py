"""Key sets too large to broadcast, and tables stored in buckets."""

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallyroom.operators import roster, sift
from tallyroom.plans import stages
from tallyroom.sources import testdata as td
from tallyroom.sources.buckets import hot_keys, read_buckets, write_buckets
from tests.frames import pricing, table, tuples

SF = "/root/testdata/sf0.01"


def test_no_row_of_a_key_is_sifted_out(spark):
    keys = spark.range(0, 3000, 3).selectExpr("concat('user', id) AS user_id")
    rows = spark.range(9000).selectExpr("concat('user', id % 3000) AS user_id", "id").unionByName(
        spark.createDataFrame([(None, -1)], "user_id string, id bigint")
    )
    for bits in (64, 1 << 14, sift.BITS):
        found = sift.sifted(rows, sift.key_words(keys, "user_id", bits), "user_id", bits)
        assert found.columns == rows.columns
        ids = {row.id for row in found.collect()}
        wanted = {i for i in range(9000) if i % 3000 % 3 == 0}
        assert wanted <= ids and -1 not in ids
        if bits > 64:
            # About 1000 of the bits are set, so that share of the other keys slips through.
            assert len(ids - wanted) <= 6000 * 2 * 1000 / bits + 3
    assert sift.sifted(rows, sift.key_words(keys.filter("false"), "user_id"), "user_id").count() == 0


def test_the_filter_has_a_bound(spark):
    keys = spark.range(200_000).selectExpr("CAST(id AS string) AS user_id")
    words = sift.key_words(keys, "user_id", 1 << 12)
    assert words.count() <= (1 << 12) // 64
    assert stages.sieve(keys, max_keys=10)(keys) is keys  # too many keys: rows pass unchanged


@pytest.fixture
def no_broadcast_sets(monkeypatch):
    for name, module in (("stages", stages), *[(job, __import__(f"tallyroom.plans.{job}", fromlist=["x"])) for job in ("roster_job", "crossings_job", "daily_report")]):
        monkeypatch.setattr(module, "fits_broadcast", lambda *_, **__: False)


@pytest.mark.parametrize(
    "name", ["payer_cohort", "tier_crossings", "entrant_last_purchases", "vip_roster", "payer_cohort_from_state", "observations"]
)
def test_sifted_queries_give_the_same_rows(spark, no_broadcast_sets, name):
    from tests.parity import duck, duck_rows, spark_rows

    found = registry.queries()[name](spark, SF)
    assert spark_rows(found) == duck_rows(duck(SF), registry.oracle_sql()[name])


def test_fewer_rows_leave_the_scan(spark, no_broadcast_sets):
    """The broadcast filter stands below the first shuffle of the history."""
    text = registry.queries()["payer_cohort"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "getbit" in text and text.index("HashAggregate") < text.index("getbit")
    history = td.purchases(spark, SF)
    keys = history.filter("user_id LIKE '1%'").select("user_id").distinct()
    passed = stages.sieve(stages.staged(keys))(history).count()
    assert passed == history.filter("user_id LIKE '1%'").count() < history.count() / 2


# Buckets


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Orders and prices in buckets; one order holds a third of the events, with very many users."""
    folder, name = tmp_path_factory.mktemp("buckets"), f"t{uuid.uuid4().hex}"
    orders = [{"order_id": i % 90, "user_id": f"u{i % 40}"} for i in range(600)]
    orders += [{"order_id": 7, "user_id": f"many{i}"} for i in range(300)]
    orders += [{"order_id": None, "user_id": "none"}, {"order_id": 5000, "user_id": "u1"}, {"order_id": 3, "user_id": None}]
    prices = [(i % 80, "x", f"0{i % 9}:00", i % 13, None if i % 5 else 1) for i in range(400)] + [(None, "x", "01:00", 99, 1)]
    events = table(spark, "orders_created", orders)
    priced = pricing(spark, *prices)
    for which, rows in (("orders", events), ("prices", priced)):
        write_buckets(rows, f"{name}_{which}", str(folder / which), "order_id", 4)
    return events, priced, f"{name}_orders", f"{name}_prices"


def test_costs_of_stored_orders(spark, stored):
    events, priced, orders, prices = stored
    wanted = roster.procurement_cost_by_user(events, roster.latest_vendor_pricing(priced))
    hot = hot_keys(read_buckets(spark, orders), "order_id", 4)
    assert hot == [7]
    for keys in (hot, []):
        found = roster.stored_procurement_cost(read_buckets(spark, orders), read_buckets(spark, prices), keys)
        assert sorted(tuples(found), key=repr) == sorted(tuples(wanted), key=repr)


def test_no_shuffle_below_the_join(spark, stored):
    _, _, orders, prices = stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = roster.stored_procurement_cost(read_buckets(spark, orders), read_buckets(spark, prices), [])
        text = found._jdf.queryExecution().executedPlan().toString()
        join = text.index("SortMergeJoin")
        below = text[join : text.index("Union", join) if "Union" in text[join:] else len(text)]
        assert "Exchange" not in below.split("HashAggregate(keys=[user_id")[0]
        assert text.count("Exchange hashpartitioning") == 1  # the sum per user
        hot = hot_keys(read_buckets(spark, orders), "order_id", 4)
        text = roster.stored_procurement_cost(read_buckets(spark, orders), read_buckets(spark, prices), hot)
        assert text._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_hold_whole_keys(spark, stored):
    _, _, orders, _ = stored
    files = read_buckets(spark, orders).filter("order_id IS NOT NULL").select("order_id", F.col("_metadata.file_name").alias("f"))
    assert files.groupBy("order_id").agg(F.count_distinct("f").alias("n")).filter("n > 1").count() == 0
