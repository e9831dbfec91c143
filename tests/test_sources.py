"""Reading canonical tables, and the command line over stored ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyroom.__main__ import main
from tallyroom.functions import within
from tallyroom.operators import daily
from tallyroom.sources import SCHEMAS, conform, current_roster, read_roster, read_sheet_csv, read_table
from tallyroom.sources import testdata as td
from tests.frames import (
    DAY,
    box_events,
    crm,
    logins,
    one,
    pricing,
    purchases,
    table,
    tuples,
    users,
)


def test_conform_casts_keeps_extras_and_names_what_is_missing(spark):
    raw = spark.sql(
        "SELECT 7 AS user_id, TIMESTAMP '2024-03-10 02:30:00 America/New_York' AS "
        "event_timestamp, DATE '2024-03-10' AS event_date"
    )
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            logins_read = conform(raw, SCHEMAS["logins"])
            row = within(logins_read, "event_timestamp").first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert tuple(row) == ("7", dt.datetime(2024, 3, 10, 7, 30), dt.date(2024, 3, 10))
    with pytest.raises(ValueError, match="event_timestamp"):
        conform(raw.drop("event_timestamp"), SCHEMAS["logins"])


def test_conform_fills_tie_breaks_and_leaves_order_ids(spark):
    events = purchases(spark, ("a", "01:00", 1, "y"), ("a", "01:00", 1, "x")).drop("event_id")
    stored = conform(events, SCHEMAS["purchases"])
    assert one(daily.top_spenders(stored, DAY))["products_bought"] == "x, y"
    orders = spark.sql("SELECT 'o-1' AS order_id, 'a' AS user_id")
    assert conform(orders, SCHEMAS["orders_created"]).first().order_id == "o-1"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "table"])
def test_formats(spark, tmp_path, fmt):
    events = purchases(spark, ("a", "01:00", "1.50", "x", None), ("b", "23:59", "2.25", None, "S"))
    if fmt == "table":
        spark.sql("CREATE DATABASE IF NOT EXISTS shop")
        events.write.mode("overwrite").saveAsTable("shop.purchases")
        location = "shop"
    else:
        location = str(tmp_path)
        events.write.format(fmt).save(f"{location}/purchases")
    stored = read_table(spark, location, "purchases", fmt)
    assert sorted(stored.schema.names) == sorted(SCHEMAS["purchases"].names)
    assert one(daily.purchase_summary(stored, DAY)) == one(daily.purchase_summary(events, DAY))


def test_derived_tables_have_the_canonical_columns(spark):
    sf = "/root/testdata/sf0.001"
    for name in SCHEMAS:
        build = getattr(td, name)
        df = build(spark, sf, td.ROSTER_AS_OF) if name == "user_crm" else build(spark, sf)
        have = dict(df.dtypes)
        for field in SCHEMAS[name]:
            if field.name in have or name != "roster_prev":
                assert have[field.name] == field.dataType.simpleString(), (name, field.name)


def test_command_line(spark, tmp_path):
    folder = str(tmp_path / "tables")
    tables = {
        "logins": logins(spark, "a", "b"),
        "purchases": purchases(spark, ("a", "01:00", 120), ("staff", "02:00", 5)),
        "box_events": box_events(spark, ("a", "Red", 10, 2, 10)),
        "user_crm": crm(spark, ("a", 120, 120, "01:00", 1, 2)),
        "internal_users": users(spark, "staff"),
        "vendor_pricing": pricing(spark, (1, "a", "01:00", 5, 1)),
        "orders_created": table(spark, "orders_created", [{"order_id": 1, "user_id": "a"}]),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    out, store = str(tmp_path / "out"), str(tmp_path / "store")
    for choice in (["--excluded", "staff"], ["--excluded-table", "internal_users"]):
        main(["daily", "--tables", folder, "--out", out, "--date", DAY, *choice])
        summary = one(spark.read.parquet(f"{out}/{DAY}/purchase_summary"))
        assert summary["total_revenue_usd"] == 120.0
        found = spark.read.parquet(f"{out}/{DAY}/observations").orderBy("rank")
        assert tuples(found, "label")[0] == ("All new payers",)
    main(["crossings", "--tables", folder, "--out", out, "--as-of", f"{DAY} 12:00:00"])
    feed = one(spark.read.parquet(f"{out}/{DAY}/entrant_feed"))
    shown = (feed["tier_crossed"], feed["net_spend_usd"], feed["purchase_count"])
    assert shown == ("VIP", 114.0, 1)
    sheet = str(tmp_path / "sheet")
    main(["roster", "--tables", folder, "--store", store, "--date", DAY, "--export-sheet", sheet])
    assert [row.user_id for row in read_sheet_csv(spark, sheet).collect()] == ["a"]
    assert one(read_roster(spark, store).select("user_id", F.col("relationship_stage"))) == {
        "user_id": "a", "relationship_stage": "new",
    }
    last = "2024-03-12"
    main(["range", "--tables", folder, "--out", out, "--date", DAY, "--last-date", last, "--excluded", "staff"])
    days = spark.read.parquet(f"{out}/{DAY}--{last}/cohort_kpis").orderBy("report_date")
    assert [(row.total_payers, row.dau) for row in days.collect()] == [(1, 2), (0, 0), (0, 0)]
    main(["roster", "--tables", folder, "--store", store, "--date", DAY, "--sheet", sheet, "--recall"])
    version = current_roster(spark, store).version
    assert spark.read.parquet(f"{store}/summaries/{version}/conflicts").count() == 0
    assert one(read_roster(spark, store).select("user_id")) == {"user_id": "a"}
