"""One user, product and box with a third of all rows, against plain Python over the same rows."""

import math
import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from tallyroom.operators import boxes, crossings, daily, roster
from tests.frames import DAY, box_events, pricing, purchases, table, ts, tuples

HOT = "hot"


def cents(value: Fraction) -> float:
    return math.floor(value * 100 + Fraction(1, 2)) / 100


@pytest.fixture(scope="module")
def sold():
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        user = HOT if i % 3 == 0 else f"u{rng.randrange(200)}"
        day = rng.choice(["2024-03-01", "2024-03-08", DAY, DAY])
        time = f"{day} {rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}"
        slug = "hot-pack" if i % 3 == 1 else rng.choice(["a", "b", None])
        rows.append((user, time, f"{rng.randrange(1, 9999) / 100:.2f}", slug))
    return rows


@pytest.fixture(scope="module")
def opened():
    rng = random.Random(6)
    return [
        (
            HOT if i % 3 == 0 else f"u{rng.randrange(260)}",
            "Hot" if i % 3 == 1 else f"Box {rng.randrange(9)}",
            rng.randrange(0, 100, 25),
            rng.randrange(7),
            f"{rng.randrange(99999) / 100:.2f}",
        )
        for i in range(3000)
    ]


@pytest.fixture(scope="module")
def bought(spark, sold):
    return purchases(spark, *sold).repartition(9).cache()


def test_top_spenders(bought, sold):
    spent, count, listed = Counter(), Counter(), defaultdict(list)
    for number, (user, time, amount, slug) in enumerate(sold):
        if time.startswith(DAY):
            spent[user] += Decimal(amount)
            count[user] += 1
            if slug:
                listed[user].append((time, number, slug))
    leaders = sorted(spent, key=lambda user: (-spent[user], user))[:5]
    assert leaders[0] == HOT and count[HOT] > 400
    assert tuples(daily.top_spenders(bought, DAY)) == [
        (user, count[user], float(spent[user]), ", ".join(s for *_, s in sorted(listed[user])))
        for user in leaders
    ]


def test_cohort(bought, sold):
    history = defaultdict(list)
    for user, time, amount, _ in sold:
        history[user].append((time[:10], Decimal(amount)))
    expected = []
    for user, events in history.items():
        today = [amount for day, amount in events if day == DAY]
        prior = [day for day, _ in events if day < DAY]
        if today:
            gap = None if not prior else int(DAY[8:]) - int(max(prior)[8:])
            total = float(sum(amount for _, amount in events))
            expected.append(
                (user, "return" if prior else "new", len(events), total, float(sum(today)), gap)
            )
    expected.sort(key=lambda row: (row[1], -row[3], row[0]))
    found = tuples(daily.payer_cohort(bought, DAY))
    assert [(*row[:5], row[6]) for row in found] == expected


def test_boxes(spark, bought, sold, opened):
    payers = {user for user, time, *_ in sold if time.startswith(DAY)}
    opens, users, prices = Counter(), defaultdict(set), defaultdict(list)
    per_user, names, coins = Counter(), defaultdict(set), Counter()
    for user, name, volatility, n, spent in opened:
        if user in payers:
            key = (name, volatility)
            opens[key] += n
            users[key].add(user)
            prices[key] += [Fraction(spent) / n] if n else []
            per_user[user] += n
            names[user].add(name)
            coins[user] += Decimal(spent)
    order = sorted(opens, key=lambda key: (-opens[key], *key))[:10]
    events = box_events(spark, *opened).repartition(9)
    assert tuples(boxes.top_boxes(events, bought, DAY)) == [
        (*key, opens[key], len(users[key]), cents(sum(prices[key]) / len(prices[key])))
        for key in order
    ]
    leaders = sorted(per_user, key=lambda user: (-per_user[user], user))[:5]
    assert tuples(boxes.top_openers(events, bought, DAY)) == [
        (user, per_user[user], len(names[user]),
         float(coins[user].quantize(Decimal(1), ROUND_HALF_UP)))
        for user in leaders
    ]
    top = Counter()
    for user, name, _, n, _ in opened:
        if user in payers and name == order[0][0]:
            top[user] += n
    assert tuples(boxes.top_box_openers(events, bought, DAY), "user_id", "opens") == sorted(
        top.items(), key=lambda row: (-row[1], row[0])
    )


def test_last_purchases(spark, bought, sold):
    wanted = {HOT, "u1", "u2"}
    crossed = spark.createDataFrame([(user,) for user in wanted], "user_id string")
    rows = sorted(
        ((user, ts(time), number, float(amount)) for number, (user, time, amount, _)
         in enumerate(sold) if user in wanted),
        key=lambda row: (row[0], -row[1].timestamp(), -row[2]),
    )
    seen, expected = Counter(), []
    for user, time, _, amount in rows:
        seen[user] += 1
        if seen[user] <= 2:
            expected.append((user, time, amount, seen[user]))
    found = crossings.entrant_last_purchases(crossed, bought, "2024-03-11 00:00:00")
    assert tuples(found, "user_id", "event_timestamp", "amount_usd", "rn") == expected


def test_procurement(spark):
    """A third of the order events without an id, a third repeats of one order."""
    rng = random.Random(7)
    events = [
        (None if i % 3 == 0 else 7 if i % 3 == 1 else rng.randrange(500), f"u{rng.randrange(40)}")
        for i in range(3000)
    ]
    prices = [
        (rng.randrange(400) if i % 3 else 7, "x", f"2024-03-0{rng.randrange(1, 9)} 10:00:00",
         rng.choice([None, rng.randrange(100)]), rng.choice([None, rng.randrange(10)]))
        for i in range(1500)
    ]
    newest = {}
    for order, _, time, price, fee in prices:
        place = (time, -1 if price is None else price, -1 if fee is None else fee)
        newest[order] = max(newest.get(order, place), place)
    costs = Counter()
    for order, user in events:
        _, price, fee = newest.get(order, ("", 0, 0))
        costs[user] += max(price, 0) + max(fee, 0)
    orders = table(
        spark, "orders_created", [{"order_id": order, "user_id": user} for order, user in events]
    )
    latest = roster.latest_vendor_pricing(pricing(spark, *prices).repartition(9))
    found = dict(tuples(roster.procurement_cost_by_user(orders.repartition(9), latest)))
    assert found == {user: float(cost) for user, cost in costs.items()}
