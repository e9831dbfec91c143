"""Edge cases of the roster operators, its store and the sheet exchange."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tallyroom.operators import roster
from tallyroom.plans import roster_job
from tallyroom.plans.roster_job import refresh_roster
from tallyroom.sources import (
    EmptyRosterError,
    MixedSheetError,
    RosterConflictError,
    commits,
    current_roster,
    note_log,
    publish_roster,
    read_roster,
    read_sheet_csv,
    sheet_base,
    write_sheet_csv,
)
from tallyroom.sources.roster_store import SHEET_ORDER
from tallyroom.sources.schemas import MANAGER_COLUMNS, NOTE_COLUMNS, ROSTER_COLUMNS
from tests.frames import crm, one, pricing, table, tuples, users

TODAY = "2024-03-10"


def test_latest_pricing_per_order(spark):
    prices = pricing(
        spark,
        (1, "a", "01:00", 5, 1),
        (1, "a", "02:00", 6, None),
        (2, "a", "01:00", 7, 1),
        (2, "a", "01:00", 7, 2),
    )
    assert sorted(tuples(roster.latest_vendor_pricing(prices))) == [(1, 6, None), (2, 7, 2)]
    reversed_ties = prices.selectExpr("*", "-vendor_fee AS place")
    latest = tuples(roster.latest_vendor_pricing(reversed_ties, ["place"]))
    assert sorted(latest) == [(1, 6, None), (2, 7, 1)]


def test_procurement_counts_missing_sides_as_zero(spark):
    orders = table(
        spark,
        "orders_created",
        [
            {"order_id": order, "user_id": user}
            for order, user in [
                (1, "a"), (1, "a"), (1, "b"), (2, "a"), (3, "a"), (None, "a"), (None, "c"),
                (4, None),
            ]
        ],
    )
    latest = pricing(
        spark,
        (1, "z", "01:00", "5.10", None),
        (2, "z", "01:00", None, "0.20"),
        (4, "z", "01:00", 1, 1),
        (None, "z", "01:00", 100, 100),
    ).select("order_id", "vendor_price", "vendor_fee")
    costs = dict(tuples(roster.procurement_cost_by_user(orders, latest)))
    assert costs == {"a": 10.4, "b": 5.1, "c": 0.0, None: 2.0}


def test_roster_tiers_and_figures(spark):
    people = crm(
        spark,
        ("goat", 1000, 1, "2024-03-09 23:59:59", 3),
        ("gold", "999.99", 1, "10:00", 0),
        ("vip", 100, 1, "10:00", 8),
        ("poor", "99.99", 1, "10:00", 1),
        ("staff", 500, 1, "10:00", 1),
        (None, 300, 1, "10:00", 7),
    )
    costs = spark.createDataFrame(
        [("goat", 0.5), ("poor", 1.0)], "user_id string, total_procurement_cost double"
    )
    rows = roster.vip_roster(people, costs, users(spark, "staff", None))
    assert tuples(
        rows, "user_id", "tier", "ltv_usd", "net_spend_usd", "last_purchase_date",
        "avg_transaction_usd",
    ) == [
        ("goat", "GOAT", 1000.0, 999.5, dt.date(2024, 3, 9), 333.33),
        ("gold", "Gold", 999.99, 999.99, dt.date(2024, 3, 10), None),
        (None, "Gold", 300.0, 300.0, dt.date(2024, 3, 10), 42.86),
        ("vip", "VIP", 100.0, 100.0, dt.date(2024, 3, 10), 12.5),
    ]


def fresh(spark, *rows):
    """Roster rows of (user, ltv, session days)."""
    people = crm(spark, *[(user, ltv, 1, "10:00", 1, days) for user, ltv, days in rows])
    costs = spark.createDataFrame([], "user_id string, total_procurement_cost double")
    return roster.vip_roster(people, costs, users(spark))


def sheet(spark, *rows):
    return table(spark, "roster_prev", rows, sheet_row="long").selectExpr(
        *[f"`{name}`" for name in (*ROSTER_COLUMNS, "sheet_row")]
    )


@pytest.fixture(scope="module")
def merged(spark):
    previous = sheet(
        spark,
        {"user_id": "twice", "relationship_stage": "engaged", "sheet_row": 1, "email": "old"},
        {"user_id": "twice", "relationship_stage": "won", "sheet_row": 10, "email": "new"},
        {"user_id": "twice", "relationship_stage": "lost", "sheet_row": 9},
        {"user_id": "blank", "manager_notes": " kept  as it is\n", "ltv_usd": 1.0, "sheet_row": 2},
        {"user_id": "", "email": "nobody", "sheet_row": 3},
        {"user_id": None, "email": "nobody", "sheet_row": 4},
        {"user_id": "left", "email": "gone", "sheet_row": 5},
    )
    return roster.merge_roster(
        fresh(spark, ("twice", 300, 1), ("blank", 200, 2), ("fresh", 100, 3)), previous
    )


def test_merge_keeps_hand_kept_columns(merged):
    rows = {row.user_id: row.asDict() for row in merged.collect()}
    assert set(rows) == {"twice", "blank", "fresh"}
    assert rows["twice"]["relationship_stage"] == "won"
    assert rows["twice"]["email"] == "new"
    assert rows["blank"]["manager_notes"] == " kept  as it is\n"
    assert rows["blank"]["relationship_stage"] == ""
    assert rows["blank"]["ltv_usd"] == 200.0
    assert rows["fresh"]["relationship_stage"] == "new"
    assert {name: rows[name]["is_new"] for name in rows} == {
        "twice": False, "blank": False, "fresh": True,
    }
    for name in ("first_name", "last_name", "email", *MANAGER_COLUMNS):
        if name != "relationship_stage":
            assert rows["fresh"][name] == ""


def test_a_cell_that_reads_as_zero_is_blank(spark):
    cells = {"0": "", " -0.00 ": "", "000": "", ".0": "", "10": "10", "0x": "0x", "no. 0": "no. 0"}
    previous = sheet(
        spark,
        *[
            {"user_id": f"u{i}", "relationship_stage": cell, "conversation_note_1": cell, "sheet_row": i}
            for i, cell in enumerate(cells)
        ],
    )
    users_found = roster.merge_roster(fresh(spark, *[(f"u{i}", 100, 1) for i in range(len(cells))]), previous)
    kept = {row.user_id: row for row in users_found.collect()}
    for i, expected in enumerate(cells.values()):
        assert kept[f"u{i}"].relationship_stage == expected
        assert kept[f"u{i}"].conversation_note_1 == expected
    contexts = dict(tuples(roster.heat_scores(users_found, TODAY), "user_id", "context_score"))
    assert contexts["u0"] == 50 and contexts["u4"] == 70


def expected_heat(days, notes):
    recency = 0.0 if days is None else round(max(0.0, 100.0 - (days / 30.0) * 100.0), 1)
    context = 70 if notes else 50
    score = round(recency * 0.5 + context * 0.5, 1)
    label = "Hot" if score >= 70 else "Warm" if score >= 40 else "Cold"
    return recency, context, score, label


def test_heat_scores_for_every_day_count(spark):
    days = [None, *range(-40, 60)]
    rows = [(f"{day}/{note}", 100 + i, day) for i, day in enumerate(days) for note in "yn"]
    merged = roster.merge_roster(
        fresh(spark, *rows),
        sheet(
            spark,
            *[
                {"user_id": user, "conversation_note_3": "called", "sheet_row": 1}
                for user, _, _ in rows
                if user.endswith("y")
            ],
        ),
    )
    scored = roster.heat_scores(merged, TODAY)
    assert scored.columns == list(ROSTER_COLUMNS)
    shown = scored.collect()
    for row in shown:
        expected = expected_heat(row.days_since_last_session, row.user_id.endswith("y"))
        assert (
            row.recency_score, row.context_score, row.hot_cold_score, row.hot_cold_label
        ) == expected
        assert row.score_updated == dt.date(2024, 3, 10)
    keys = [(row.hot_cold_score, -row.ltv_usd, row.user_id) for row in shown]
    assert keys == sorted(keys) and len(keys) == len(rows)


@pytest.fixture(scope="module")
def scored(spark):
    note = dict.fromkeys(NOTE_COLUMNS, " \t\n ")
    previous = sheet(
        spark,
        {"user_id": "cold padded", "relationship_stage": " new\t", "sheet_row": 1, **note},
        {"user_id": "cold other", "relationship_stage": "newer", "sheet_row": 2},
        {"user_id": "hot noted", "conversation_note_1": "1", "sheet_row": 3},
    )
    rows = fresh(
        spark, ("cold padded", 100, 30), ("cold other", 100, 30), ("cold rich", 900, 30),
        ("hot noted", 100, 9), ("hot", 150, 3), ("warm", 100, 4), ("unseen", 100, None),
    )
    return roster.heat_scores(roster.merge_roster(rows, previous), TODAY)


def test_summaries(scored):
    assert sorted(tuples(roster.heat_summary(scored))) == [
        ("Cold", 4, 7), ("Hot", 2, 7), ("Inactive", 0, 7), ("Warm", 1, 7),
    ]
    assert tuples(roster.needs_attention(scored)) == [
        ("cold rich", "Gold", 900.0, 30, 25.0),
        ("cold padded", "VIP", 100.0, 30, 25.0),
        ("unseen", "VIP", 100.0, None, 25.0),
    ]
    assert tuples(roster.needs_attention(scored, 1), "user_id") == [("cold rich",)]
    assert tuples(roster.hot_list(scored)) == [
        ("hot", "VIP", 150.0, 70.0), ("hot noted", "VIP", 100.0, 70.0),
    ]


def test_summaries_of_an_empty_roster(spark, scored):
    none = scored.filter("false")
    assert {label: (n, total) for label, n, total in tuples(roster.heat_summary(none))} == {
        label: (0, 0) for label in ("Hot", "Warm", "Cold", "Inactive")
    }


def test_published_versions(spark, scored, tmp_path):
    store = str(tmp_path / "store")
    assert read_roster(spark, store).count() == 0
    first = publish_roster(scored, store, TODAY)
    second = publish_roster(scored.filter("ltv_usd > 100"), store, "2024-03-11")
    assert read_roster(spark, store).count() == 2
    assert read_roster(spark, store, first).count() == 7
    with pytest.raises(EmptyRosterError):
        publish_roster(scored.filter("false"), store, "2024-03-12")
    assert sorted(tuples(read_roster(spark, store), "user_id")) == [("cold rich",), ("hot",)]
    assert second.startswith("20240311-")
    third = publish_roster(scored, store, "2024-03-13")
    assert read_roster(spark, store).count() == 7 and third.startswith("20240313-")
    assert current_roster(spark, store) == (third, 3)


def announced(spark, store, *rows):
    """An older layout: versions as rows of a table, (version, clock, number)."""
    spark.createDataFrame(
        [(version, dt.date(2024, 3, 10), 7, number, dt.datetime.fromisoformat(clock)) for version, clock, number in rows],
        "version string, snapshot_date date, users bigint, sequence bigint, published_at timestamp",
    ).write.mode("append").parquet(f"{store}/published")


def test_announcements_as_rows_are_continued(spark, scored, tmp_path):
    store = str(tmp_path / "store")
    announced(spark, store)
    assert read_roster(spark, store).count() == 0 and current_roster(spark, store) == (None, 0)
    for name, rows in (("first", scored), ("second", scored.filter("ltv_usd > 100"))):
        rows.write.parquet(f"{store}/versions/{name}")
    # A clock that runs ahead does not stay in front.
    announced(spark, store, ("second", "2024-03-11", 2), ("first", "2999-01-01", 1))
    assert current_roster(spark, store) == ("second", 2) and read_roster(spark, store).count() == 2
    third = publish_roster(scored, store, "2024-03-13")
    assert current_roster(spark, store) == (third, 3) and read_roster(spark, store).count() == 7


def test_of_two_writers_on_one_base_one_gets_the_number(spark, scored, tmp_path):
    store = str(tmp_path / "store")
    publish_roster(scored, store, TODAY)
    base = current_roster(spark, store).sequence
    won = publish_roster(scored.filter("ltv_usd > 100"), store, TODAY, base=base)
    with pytest.raises(RosterConflictError, match="started from 1"):
        publish_roster(scored, store, TODAY, base=base)
    assert current_roster(spark, store) == (won, 2)
    # What the loser wrote is gone, and so are the files beside the commits.
    assert len(list((tmp_path / "store" / "versions").iterdir())) == 2
    assert sorted(f.name for f in (tmp_path / "store" / "commits").iterdir() if not f.name.startswith(".")) == [
        "000000000001.json", "000000000002.json",
    ]


def test_writers_at_the_same_time_get_a_number_each(spark, scored, tmp_path):
    store = str(tmp_path / "store")
    small = scored.limit(2)
    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(lambda _: publish_roster(small, store, TODAY), range(6)))
    entries = [commits.entry_of(spark, f"{store}/commits", n)["version"] for n in range(1, 7)]
    assert sorted(entries) == sorted(versions) and current_roster(spark, store) == (entries[-1], 6)


def test_one_commit_of_many_at_once(spark, tmp_path):
    def attempt(n):
        try:
            commits.commit(spark, str(tmp_path / "c"), 1, {"writer": n})
            return n
        except commits.CommitConflictError:
            return None

    assert commits.latest(spark, str(tmp_path / "c")) is None
    with ThreadPoolExecutor(8) as pool:
        won = [n for n in pool.map(attempt, range(16)) if n is not None]
    assert len(won) == 1 and commits.latest(spark, str(tmp_path / "c")) == (1, {"writer": won[0]})


def test_commits_by_rename(spark, tmp_path, monkeypatch):
    """The road of file systems that rename without overwriting, as far as a local one can show it."""
    monkeypatch.setattr(commits, "LINKED", ())
    folder = str(tmp_path / "c")
    commits.commit(spark, folder, 1, {"writer": "first"})
    with pytest.raises(commits.CommitConflictError, match="number 1"):
        commits.commit(spark, folder, 1, {"writer": "second"})
    commits.commit(spark, folder, 2, {"writer": "é"})
    assert commits.latest(spark, folder) == (2, {"writer": "é"}) and commits.entry_of(spark, folder, 1) == {"writer": "first"}
    monkeypatch.setattr(commits, "EXCLUSIVE", ("hdfs",))
    with pytest.raises(ValueError, match="not file"):
        commits.commit(spark, folder, 3, {})


def refresh_inputs(spark):
    people = crm(spark, ("a", 300, 1, "10:00", 2, 1), ("b", 120, 1, "10:00", 2, 29), ("c", 150, 1, "10:00", 1, 3))
    orders = table(spark, "orders_created", [{"order_id": 1, "user_id": "a"}])
    return people, orders, pricing(spark, (1, "a", "01:00", 5, 1)), users(spark)


def noted(spark, rows):
    return sheet(spark, *[{"user_id": user, "manager_notes": note, "sheet_row": i} for i, (user, note) in enumerate(rows)])


def notes(refreshed):
    return dict(tuples(refreshed.roster, "user_id", "manager_notes"))


def test_a_refresh_that_is_overtaken_merges_again(spark, tmp_path, monkeypatch):
    args = (*refresh_inputs(spark), str(tmp_path / "store"), TODAY)
    refresh_roster(*args)
    overtaking = iter([noted(spark, [("a", "from the other refresh")])])
    publish = roster_job.publish_roster

    def overtaken(*given, **named):
        other = next(overtaking, None)
        if other is not None:
            refresh_roster(*args, roster_prev=other)
        return publish(*given, **named)

    monkeypatch.setattr(roster_job, "publish_roster", overtaken)
    late = refresh_roster(*args)
    assert notes(late) == {"a": "from the other refresh", "b": "", "c": ""}
    assert current_roster(spark, args[4]) == (late.version, 3)
    # Without a base there is nothing to merge with, and with no attempts left there is no time to.
    overtaking = iter([noted(spark, [("a", "again")])])
    with pytest.raises(RosterConflictError):
        refresh_roster(*args, roster_prev=noted(spark, [("b", "x")]))
    overtaking = iter([noted(spark, [("a", "again")])])
    with pytest.raises(RosterConflictError):
        refresh_roster(*args, attempts=1)
    assert notes(refresh_roster(*args)) == {"a": "again", "b": "", "c": ""}


def test_notes_saved_between_export_and_import_survive(spark, tmp_path):
    store = str(tmp_path / "store")
    args = (*refresh_inputs(spark), store, TODAY)
    first = refresh_roster(*args, roster_prev=noted(spark, [("a", "old a"), ("b", "old b")]))
    write_sheet_csv(first.roster, str(tmp_path / "sheet"), first.version)
    # Another manager saves notes of a and c; the sheet has edits of a and b.
    refresh_roster(*args, roster_prev=noted(spark, [("a", "other a"), ("b", "old b"), ("c", "other c")]))
    exported = read_sheet_csv(spark, str(tmp_path / "sheet"))
    assert sheet_base(exported) == first.version
    edits = {"a": "sheet a", "b": "sheet b"}
    own = F.create_map(*[F.lit(x) for pair in edits.items() for x in pair])
    note = F.coalesce(F.try_element_at(own, F.col("user_id")), "manager_notes")
    edited = exported.withColumn("manager_notes", note)
    found = refresh_roster(*args, roster_prev=edited, sheet_order=SHEET_ORDER, sheet_base=first.version)
    assert notes(found) == {"a": "sheet a", "b": "sheet b", "c": "other c"}
    clash = ("a", "manager_notes", "old a", "sheet a", "other a", "sheet a")
    assert tuples(found.conflicts) == [clash] and set(found.results()) >= {"conflicts", "roster"}
    kept = refresh_roster(*args, roster_prev=edited, sheet_order=SHEET_ORDER, sheet_base=first.version, prefer="current")
    assert notes(kept)["c"] == "other c"
    mixed = exported.withColumn("roster_version", F.when(F.col("user_id") == "a", "x").otherwise("y"))
    with pytest.raises(MixedSheetError):
        sheet_base(mixed)


def test_merge_of_single_cells(spark):
    cases = {  # base, sheet, current -> with the sheet preferred, with the current one, conflict
        "none": ("x", "x", "x", "x", "x", False),
        "edited": ("x", "y", "x", "y", "y", False),
        "moved on": ("x", "x", "y", "y", "y", False),
        "same": ("x", "y", "y", "y", "y", False),
        "both": ("x", "y", "z", "y", "z", True),
        "cleared": ("x", "", "x", "", "", False),
        "cleared by both": ("x", "", None, "", "", False),
        "cleared and changed": ("x", "", "z", "", "z", True),
        "zero is blank": ("x", "0", " 0.0 ", "", "", False),
        "blank to blank": (None, "", "0", "", "", False),
    }
    sides = [noted(spark, [(user, case[side]) for user, case in cases.items()]) for side in range(3)]
    for prefer, at in (("sheet", 3), ("current", 4)):
        found = roster.merge_sheet(*sides, prefer=prefer)
        rows = {r.user_id: r for r in found.collect()}
        assert {u: r.manager_notes for u, r in rows.items()} == {u: case[at] for u, case in cases.items()}
        assert {u: bool(r.conflicts) for u, r in rows.items()} == {u: case[5] for u, case in cases.items()}
        listed = tuples(roster.sheet_conflicts(found), "user_id", "base", "sheet", "current", "taken")
        assert sorted(listed) == [(u, case[0], case[1], case[2], case[at]) for u, case in sorted(cases.items()) if case[5]]
    with pytest.raises(ValueError, match="prefer"):
        roster.merge_sheet(*sides, prefer="both")


def test_merge_of_rows_that_only_some_sides_have(spark):
    base = noted(spark, [("a", "x"), ("b", "x"), ("c", "x"), ("twice", "x")])
    edited = noted(spark, [("a", "y"), ("added", "y"), ("twice", "first"), ("twice", "last"), ("", "nobody"), (None, "nobody")])
    now = noted(spark, [("b", "z"), ("joined", "z"), ("added", "w"), ("twice", "x")])
    found = dict(tuples(roster.merge_sheet(base, edited, now), "user_id", "manager_notes"))
    assert found == {"a": "y", "b": "z", "c": "x", "twice": "last", "added": "y", "joined": "z"}
    nothing = base.filter("false")
    assert dict(tuples(roster.merge_sheet(nothing, edited, nothing), "user_id", "manager_notes"))["added"] == "y"
    assert roster.merge_sheet(nothing, nothing, nothing).count() == 0


def test_sheet_round_trip(spark, scored, tmp_path):
    path = str(tmp_path / "sheet")
    odd = scored.selectExpr(
        *[
            "concat(manager_notes, ' \"quoted\", two\\nlines; ', user_id) AS manager_notes"
            if name == "manager_notes"
            else name
            for name in ROSTER_COLUMNS
        ]
    )
    write_sheet_csv(odd, path)
    back = read_sheet_csv(spark, path)
    blanks = odd.fillna("")
    assert sorted(tuples(back, *ROSTER_COLUMNS), key=repr) == sorted(tuples(blanks), key=repr)
    again = roster.merge_roster(fresh(spark, ("hot", 100, 1)), back, SHEET_ORDER)
    assert one(again)["manager_notes"] == ' "quoted", two\nlines; hot'


def test_last_row_of_a_sheet_file_wins(spark, scored, tmp_path):
    header = ",".join(ROSTER_COLUMNS)
    place = ROSTER_COLUMNS.index("manager_notes")
    lines = [",".join(["u", *[""] * (place - 1), note, *[""] * 5]) for note in "abc"]
    (tmp_path / "sheet.csv").write_text("\n".join([header, *lines]) + "\n")
    sheet_rows = read_sheet_csv(spark, str(tmp_path / "sheet.csv"))
    kept = roster.merge_roster(fresh(spark, ("u", 100, 1)), sheet_rows, SHEET_ORDER)
    assert one(kept)["manager_notes"] == "c"


def test_refresh_twice_changes_nothing_but_the_version(spark, tmp_path):
    people = crm(spark, ("a", 300, 1, "10:00", 2, 1), ("b", 120, 1, "10:00", 2, 29))
    orders = table(spark, "orders_created", [{"order_id": 1, "user_id": "a"}])
    prices = pricing(spark, (1, "a", "01:00", 5, 1), (2, "x", "01:00", 5, 1))
    store = str(tmp_path / "store")
    args = (people, orders, prices, users(spark), store, TODAY)
    edited = sheet(
        spark,
        {"user_id": "a", "manager_notes": "call", "relationship_stage": "won", "sheet_row": 1},
    )
    first = refresh_roster(*args, roster_prev=edited)
    second = refresh_roster(*args)
    assert tuples(first.roster) == tuples(second.roster)
    assert tuples(second.roster, "user_id", "net_spend_usd", "manager_notes") == [
        ("b", 120.0, ""), ("a", 294.0, "call"),
    ]
    assert tuples(second.hot_list, "user_id") == [("a",)]
    assert tuples(second.needs_attention, "user_id") == [("b",)]
    nobody = crm(spark, ("a", 50, 1, "10:00"))
    with pytest.raises(EmptyRosterError):
        refresh_roster(nobody, *args[1:])
    assert read_roster(spark, store).count() == 2


def test_users_who_come_back_get_their_notes(spark, tmp_path):
    people, *rest = refresh_inputs(spark)
    store = str(tmp_path / "store")
    first = noted(spark, [("a", "old"), ("b", "keep")]).withColumn("email", F.concat("user_id", F.lit("@x")))
    refresh_roster(people, *rest, store, TODAY, roster_prev=first)
    refresh_roster(people, *rest, store, TODAY, roster_prev=noted(spark, [("a", "newer"), ("b", "keep")]))
    refresh_roster(people, *rest, store, TODAY, roster_prev=noted(spark, [("a", ""), ("b", "keep")]))
    # Only what a version changed is in the log.
    log = sorted(tuples(note_log(spark, store)), key=repr)
    assert [row for row in log if row[1] == "manager_notes"] == [
        ("a", "manager_notes", "newer", 2), ("a", "manager_notes", "old", 1), ("b", "manager_notes", "keep", 1),
    ]
    without = people.filter("user_id <> 'a'")
    refresh_roster(without, *rest, store, TODAY)
    plainly = refresh_roster(people, *rest, store, TODAY)
    assert notes(plainly)["a"] == "" and ("a", "new") in tuples(plainly.roster, "user_id", "relationship_stage")
    refresh_roster(without, *rest, store, TODAY)
    recalled = refresh_roster(people, *rest, store, TODAY, recall=True)
    assert notes(recalled) == {"a": "newer", "b": "keep", "c": ""}
    assert ("a", "a@x") in tuples(recalled.roster, "user_id", "email")
    # Recalling changes nothing for those who are there, blank cells included.
    again = refresh_roster(people, *rest, store, TODAY, roster_prev=noted(spark, [("a", ""), ("b", "b2")]), recall=True)
    assert notes(again) == {"a": "", "b": "b2", "c": ""}
    assert tuples(note_log(spark, str(tmp_path / "none"))) == []


def test_a_version_that_lost_leaves_no_notes(spark, scored, tmp_path):
    store = str(tmp_path / "store")
    noted_rows = scored.withColumn("manager_notes", F.lit("won"))
    publish_roster(noted_rows, store, TODAY, base=0)
    with pytest.raises(RosterConflictError):
        publish_roster(scored.withColumn("manager_notes", F.lit("lost")), store, TODAY, base=0)
    assert {row.value for row in note_log(spark, store).filter("field = 'manager_notes'").collect()} == {"won"}
