"""Rounding and text expressions against Python's own."""

import math
import random
from decimal import Decimal

import duckdb
from pyspark.sql import functions as F

from oracles.steps import _mean

from tallyroom.functions import mean2, product_label, py_round1, round2, stripped, whole_pct


def applied(spark, expression, values, kind):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    results = frame.select("i", expression(F.col("v")).alias("r")).orderBy("i")
    return [row.r for row in results.collect()]


def test_one_digit_matches_python(spark):
    random.seed(7)
    values = [i / 20 for i in range(20000)]
    values += [a / b * 100 for a in range(1, 120) for b in range(1, 120)]
    values += [math.nextafter(i / 20, way) for i in range(2000) for way in (0.0, 1e9)]
    values += [random.random() * 10 ** random.randint(-3, 9) for _ in range(20000)]
    assert applied(spark, py_round1, values, "double") == [round(v, 1) for v in values]


def test_whole_percent_matches_python(spark):
    pairs = [(a, b) for a in range(0, 90) for b in range(0, 90)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    for row in frame.select("a", "b", whole_pct(F.col("a"), F.col("b")).alias("p")).collect():
        assert row.p == (round(row.a / row.b * 100) if row.b else 0)


def test_money_rounds_half_up(spark):
    values = [Decimal("1.005"), Decimal("-1.005"), Decimal("2.344999"), None]
    assert applied(spark, round2, values, "decimal(38,10)") == [1.01, -1.01, 2.34, None]


def test_means_are_rounded_once(spark):
    """(cents, count) -> half up on the exact ratio, also just beside a tie."""
    random.seed(8)
    pairs = [(1005100, 10001), (-1005100, 10001), (1005, 10), (-1005, 10), (1, 2), (-1, 2), (0, 3), (7, 0)]
    pairs += [(random.randint(-(10**13), 10**13), random.randint(1, 10**9)) for _ in range(2000)]
    pairs += [(n // 2 + step, n) for n in (10**9, 10**9 + 1) for step in (-1, 0, 1)]
    frame = spark.createDataFrame([(i, Decimal(c), n) for i, (c, n) in enumerate(pairs)], "i int, c decimal(38,0), n long")
    found = [r.m for r in frame.select("i", mean2(F.col("c"), F.col("n")).alias("m")).orderBy("i").collect()]
    half_up = [None if not n else (1 if c > 0 else -1) * ((2 * abs(c) + n) // (2 * n)) / 100 for c, n in pairs]
    assert found == half_up and found[:2] == [1.0, -1.0]
    sql = " UNION ALL ".join(f"SELECT {i} AS i, {_mean(str(c), str(n))} AS m" for i, (c, n) in enumerate(pairs[:50]))
    assert [m for _, m in duckdb.sql(f"SELECT * FROM ({sql}) ORDER BY i").fetchall()] == half_up[:50]


def test_labels_match_title_case(spark):
    slugs = [
        "5k-coins-shop-item", "a-1b2c", "don't-stop", "ÉCOLE-été", "", "-", "x", "shop-item",
        "UPPER-case", "two--dashes", "9-9", "日本-pack",
    ]
    expected = [
        "5K Coins", "A 1B2C", "Don'T Stop", "École Été", "", " ", "X", "Shop Item",
        "Upper Case", "Two  Dashes", "9 9", "日本 Pack",
    ]
    assert applied(spark, product_label, slugs, "string") == expected


def test_strip_matches_python(spark):
    texts = [" a ", "\t\n", " x ", "\x1f\x1ca b\x85", "", "a\n\n", "\n \nmid dle\r\n"]
    assert applied(spark, stripped, texts, "string") == [t.strip() for t in texts]
