from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.operators.expectations import enforce, tally
from fareline.operators.lookup import lookup, orphans
from fareline.operators.quality import TableTests, freshness, run_tests
from fareline.operators.upsert import merge_rows, newer_than, table_changes
from fareline.operators.versions import count_occurrences, first_per_key
from fareline.plans.reference import checked_reference, current_reference


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_limits_groups_before_the_shuffle(rows):
    df = rows([(1, 1), (1, 3), (1, 2), (2, 5), (None, 7), (None, 8)], "k int, v int")
    first = first_per_key(df, ["k"], [F.col("v").desc()])
    assert sorted(first.collect(), key=str) == [(1, 3), (2, 5), (None, 8)]
    text = plan(first)
    assert text.index("Partial") > text.index("Exchange hashpartitioning")  # below it in the tree


def test_occurrences_count_nulls_as_one_key(rows):
    df = rows([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (None, "f")], "k int, v string")
    counted = {row.v: row.n for row in count_occurrences(df, "k", "n").collect()}
    assert counted == {"a": 2, "b": 2, "c": 1, "d": 3, "e": 3, "f": 3}


def test_lookup_gives_the_same_rows_broadcast_or_shuffled(spark, rows):
    facts = rows([(i, i % 3 if i % 7 else None) for i in range(300)], "id int, k int")
    table = rows([(0, "zero"), (1, "one")], "key int, name string")
    small = lookup(facts, table, "k", "key", label="name")
    expected = {row.id: row.label for row in small.collect()}
    assert len(expected) == 300 and expected[1] == "one" and expected[2] is None and expected[7] is None
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = lookup(facts, table, "k", "key", label="name")
        assert "SortMergeJoin" in plan(shuffled)
        assert {row.id: row.label for row in shuffled.collect()} == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_orphans_ignore_nulls(rows):
    """Two columns with parents of their own; a key may be known to the other one's only."""
    child = rows([(1, "a"), (1, "z"), (9, None), (9, "z"), (9, "a"), (None, "9")], "k int, c string")
    parents = {"k": (rows([(1,), (2,)], "id bigint"), "id"), "c": (rows([("a",), ("a",)], "name string"), "name")}
    found = orphans(child, parents)
    assert sorted(map(tuple, found.collect())) == [("c", "9", 1), ("c", "z", 2), ("k", "9", 3)]


def relations(df):
    """How often the optimised plan reads parquet files."""
    return df._jdf.queryExecution().optimizedPlan().toString().count(" parquet")


def test_key_tests_read_a_table_once(spark, rows, tmp_path):
    ddl = "k int, p int, q int, v int"
    rows([(1, 1, 7, 1), (1, 2, 1, 2), (2, None, 1, 30)], ddl).write.parquet(str(tmp_path / "child"))
    child, parent = spark.read.parquet(str(tmp_path / "child")), rows([(1,)], "id int")
    parents = {"p": ("parent", "id"), "q": ("parent", "id")}
    suite = {"t": TableTests(unique=["k"], not_null=["p"], relationships=parents, accepted_range={"v": (0, 10)})}
    report = run_tests({"t": child, "parent": parent}, suite)
    assert {(r.test, r.column_name): r.failures for r in report.collect()} == {
        ("not_null", "p"): 1, ("accepted_range", "v"): 1, ("unique", "k"): 1, ("relationships", "p"): 1, ("relationships", "q"): 1,
    }
    assert relations(report) == 1
    assert relations(orphans(child, {c: (parent, "id") for c in "pq"})) == 1


def test_tests_of_several_tables_are_counted_in_one_shuffle(rows):
    """Equal keys of two tables and of two columns stay apart, and tables without keys have their checks."""
    one, two = rows([(1, 1), (2, 1), (2, None)], "k int, p int"), rows([("1", None), ("1", 3), (None, 3)], "k string, v int")
    suite = {
        "one": TableTests(unique=["k", "p"], relationships={"p": ("two", "k")}),
        "two": TableTests(unique=["k"], not_null=["v", "k"]),
        "checks": TableTests(expression={"v": "v < 3"}),
        "none": TableTests(),
    }
    report = run_tests({"one": one, "two": two, "checks": two, "none": one}, suite)
    assert {(r.table_name, r.test, r.column_name): r.failures for r in report.collect()} == {
        ("one", "unique", "k"): 1, ("one", "unique", "p"): 1, ("one", "relationships", "p"): 0,
        ("two", "unique", "k"): 1, ("two", "not_null", "v"): 1, ("two", "not_null", "k"): 1, ("checks", "expression", "v"): 2,
    }


def test_freshness_of_several_sources_in_one_scan(spark, rows, tmp_path):
    rows([("a", datetime(2026, 1, 1)), ("b", datetime(2025, 1, 1)), ("other", None)], "s string, at timestamp").write.parquet(
        str(tmp_path / "t")
    )
    now = F.lit("2026-01-01 00:31:00").cast("timestamp")
    found = freshness(spark.read.parquet(str(tmp_path / "t")), "at", now, 30, 180, source="s", sources=["a", "b", "none"])
    assert {r.s: r.status for r in found.collect()} == {"a": "warn", "b": "error", "none": "error"}
    assert relations(found) == 1


RULES = (S.Rule("positive", "v > 0", "drop"), S.Rule("small", "v < 10", "warn"))


def test_enforce_drops_and_counts(rows):
    from pyspark.sql import Observation

    df = rows([(1,), (0,), (50,), (None,)], "v int")
    seen = Observation()
    assert [r.v for r in enforce(df, RULES, seen).collect()] == [1, 50]
    # A null meets no condition; counts are taken before rows are dropped.
    assert seen.get == {"rows": 4, "positive": 2, "small": 2}
    assert [r.v for r in enforce(df, RULES, null_passes=True).collect()] == [1, 50, None]
    assert {r.constraint: (r.violations, r.passed) for r in tally(df, RULES).collect()} == {
        "positive": (2, 2), "small": (2, 2),
    }


def test_fail_rule_stops_the_job(rows):
    strict = (S.Rule("present", "v is not null", "fail"),)
    assert enforce(rows([(1,)], "v int"), strict).count() == 1
    with pytest.raises(Exception, match="constraint present violated"):
        enforce(rows([(1,), (None,)], "v int"), strict).count()


def test_table_tests_on_good_and_broken_rows(rows):
    parent = rows([(1,), (2,)], "id int")
    suite = {
        "t": TableTests(
            unique=["k"],
            not_null=["k"],
            relationships={"p": ("parent", "id")},
            accepted_values={"c": ["x", "y"]},
            accepted_range={"v": (0, 10)},
            expression={"v": "v <> 5"},
        )
    }
    ddl = "k int, p int, c string, v int"
    good = rows([(1, 1, "x", 0), (2, 2, None, 10), (3, None, "y", None)], ddl)
    report = run_tests({"t": good, "parent": parent}, suite)
    assert {r.failures for r in report.collect()} == {0}
    broken = rows([(1, 7, "z", -1), (1, 7, "x", 11), (None, 1, "x", 5), (None, 1, "x", 5)], ddl)
    report = run_tests({"t": broken, "parent": parent}, suite)
    assert {r.test: r.failures for r in report.collect()} == {
        "unique": 1, "not_null": 2, "relationships": 2, "accepted_values": 1,
        "accepted_range": 2, "expression": 2,
    }


def test_empty_table_passes_its_tests(rows):
    suite = {"t": TableTests(unique=["k"], not_null=["k"], relationships={"k": ("p", "k")})}
    empty = rows([], "k int")
    assert {r.failures for r in run_tests({"t": empty, "p": empty}, suite).collect()} == {0}


@pytest.mark.parametrize("minute, status", [(0, "pass"), (30, "pass"), (31, "warn"), (180, "warn"), (181, "error")])
def test_freshness_thresholds(rows, minute, status):
    df = rows([(datetime(2026, 1, 1, 0, 0),), (datetime(2025, 1, 1),)], "at timestamp")
    now = F.lit("2026-01-01").cast("timestamp") + F.expr(f"interval {minute} minute")
    assert freshness(df, "at", now, 30, 180).first().status == status


def test_freshness_of_an_empty_table_is_an_error(rows):
    assert freshness(rows([], "at timestamp"), "at", F.current_timestamp(), 30, 180).first().status == "error"


CITY = S.REFERENCES["ref_cities"]
FEED = "city_id string, city string, state string, region string, _source_file string, _source_modified_at timestamp, _ingested_at timestamp"


def city(key, name, day, file="f"):
    return (key, name, "S", "R", file, datetime(2026, 1, day), datetime(2026, 1, day))


def test_reference_keeps_the_newest_version(rows):
    feed = rows([city("1", "old", 1), city("1", "new", 2), city("2", "b", 1, "f1"), city("2", "c", 1, "f2")], FEED)
    current = checked_reference(feed, CITY)
    assert {r.city_id: (r.city, r._key_occurrences) for r in current.collect()} == {1: ("new", 1), 2: ("c", 1)}


def test_reference_counts_keys_after_the_cast(rows):
    feed = rows([city("1", "a", 1), city("01", "b", 1)], FEED)
    assert {r._key_occurrences for r in current_reference(feed, CITY).collect()} == {2}
    with pytest.raises(Exception, match="key_is_unique"):
        checked_reference(feed, CITY).collect()


def test_reference_with_an_unreadable_key_fails(rows):
    with pytest.raises(Exception, match="key_not_null"):
        checked_reference(rows([city("x", "a", 1)], FEED), CITY).collect()


def test_look_back_reaches_one_hour_behind_the_newest_row(rows):
    target = rows([(datetime(2026, 1, 1, 12),)], "at timestamp")
    source = rows([(datetime(2026, 1, 1, 11),), (datetime(2026, 1, 1, 11, 0, 1),), (datetime(2026, 1, 2),)], "at timestamp")
    assert newer_than(source, target, "at").count() == 2
    assert newer_than(source, target.limit(0), "at").count() == 3


def test_merge_updates_inserts_and_appends_columns(rows):
    target = rows([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, v double")
    batch = rows([(2, 20, "p"), (3, 30, "q")], "id int, v int, extra string")
    merged = merge_rows(target, batch, "id")
    assert merged.dtypes == [("id", "int"), ("name", "string"), ("v", "double"), ("extra", "string")]
    assert sorted(map(tuple, merged.collect())) == [(1, "a", 1.0, None), (2, None, 20.0, "p"), (3, None, 30.0, "q")]


def test_changes_between_two_states(rows):
    ddl = "id int, v string"
    old = rows([(1, "same"), (2, "old"), (3, "gone"), (4, None)], ddl)
    new = rows([(1, "same"), (2, "new"), (4, None), (5, None)], ddl)
    assert sorted(map(tuple, table_changes(old, new, "id").collect()), key=str) == sorted(
        [(2, "old", "update_preimage"), (2, "new", "update_postimage"), (3, "gone", "delete"), (5, None, "insert")],
        key=str,
    )
