"""Every registered query against its SQL on the smallest test tables."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import compare, database

from __spark_entry__ import entry, oracle_sql
from fareline.plans.enrich import rides_enriched
from fareline.workload import queries
from fareline.workload.queries import QUERIES
from fareline.workload.rides import references, silver_rides

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_rides_of_one_row_group_are_derived_in_many_tasks(spark, tmp_path):
    """The table of orders is one file with one row group, which one task reads."""
    silver_rides(spark, "/root/testdata/sf0.1").write.parquet(str(tmp_path / "rides"))
    sizes = [path.stat().st_size for path in (tmp_path / "rides").glob("*.parquet")]
    assert len(sizes) >= 2 and max(sizes) < 1.5 * sum(sizes) / len(sizes)


def test_of_the_first_state_only_what_is_asked_for_is_stored(spark, monkeypatch):
    stored = {}

    def spy(rows, purpose):
        stored[purpose] = rows.columns
        return keep(rows, purpose)

    keep = queries.stored
    monkeypatch.setattr(queries, "stored", spy)
    for name in ("fct_upsert", "table_changes"):
        QUERIES[name](spark, SF_DIR)
    assert set(stored) == {"fct-upsert-source", "table-changes-source", "table-changes-first"}
    assert stored["table-changes-first"] == ["ride_id", "date_key", "ride_status_key", "total_fare"]


def odd_orders(spark, folder, count=3000):
    """A folder with a table of orders, some of whose columns are null."""
    k = F.col("id")
    columns = {
        "o_orderkey": k, "o_custkey": F.when(k % 41 != 0, k % 97), "o_orderstatus": F.element_at(F.array(*map(F.lit, "FOP")), (k % 3 + 1).cast("int")),
        "o_totalprice": k * 1.5, "o_orderdate": F.expr("timestamp_ntz'1995-01-01' + id % 2000 * interval 1 day"), "o_orderpriority": F.lit("1-URGENT"),
    }
    spark.range(1, count + 1).select(*[column.alias(name) for name, column in columns.items()]).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def room(folder):
    return sum(path.stat().st_size for path in folder.rglob("part-*"))


@pytest.fixture
def kept(monkeypatch, tmp_path):
    """Where the queries keep what they write."""
    monkeypatch.setattr(queries, "scratch", lambda spark, purpose: str(tmp_path / "kept" / purpose))
    monkeypatch.setattr(queries, "_STORED", {})
    return tmp_path / "kept"


def test_end_to_end_keeps_its_tables_in_little_room(spark, tmp_path, kept):
    sf_dir = odd_orders(spark, tmp_path / "tables")
    found = QUERIES["end_to_end_kpi"](spark, sf_dir).collect()
    rides = silver_rides(spark, sf_dir)
    assert sum(r.total_rides for r in found) == rides_enriched(rides, references(spark)).count()
    text = queries.bulk_lines(rides).agg(F.sum(F.length("value"))).first()[0]
    # All tables stay; the producer's files and topic are gone, and no table of all rides was stored beside them.
    assert {path.name for path in kept.iterdir()} == {"end-to-end"}
    assert {path.name for path in (kept / "end-to-end").iterdir()} == {"bronze", "silver", "gold", "raw", "manifest"}
    assert {path.name for path in (kept / "end-to-end" / "silver").iterdir()} >= {"staging_rides", "rides_enriched", "ref_cities"}
    assert 0 < room(kept / "end-to-end" / "raw") < text / 3
    assert 0 < room(kept / "end-to-end" / "bronze" / "rides_raw") < text / 3


def test_landing_again_keeps_its_files_in_little_room(spark, tmp_path, kept):
    sf_dir = odd_orders(spark, tmp_path / "tables")
    found = {(r.file_name, r.vehicle_color): r.rows for r in QUERIES["landing_again"](spark, sf_dir).collect()}
    lines = queries.bulk_lines(silver_rides(spark, sf_dir)).cache()
    sizes = {f"rides_{r.part}.json": r["count"] for r in lines.groupBy((F.col("k") % 3).alias("part")).count().collect()}
    assert found == {(name, "Black"): size for name, size in sizes.items()} | {("rides_1.json", "Blue"): sizes["rides_1.json"]}
    text = lines.agg(F.sum(F.length("value"))).first()[0]
    lines.unpersist()
    assert {path.name for path in kept.iterdir()} == {"landing-again"}
    assert 0 < room(kept / "landing-again" / "files") < text / 3
    assert 0 < room(kept / "landing-again" / "raw" / "folder_name=bulk_rides") < text / 3


@pytest.mark.parametrize("absent", ["fareline.llm", "corpus_pipeline", "ahocorasick"])
def test_the_rest_goes_on_without_the_training_data_operators(absent):
    """In a process of its own, where the module, or one that only they need, can't be imported."""
    code = (
        f"import sys; sys.modules[{absent!r}] = None\n"
        "import __spark_entry__ as e; from fareline.workload.queries import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql()), set(e.queries()) ^ set(QUERIES)"
    )
    root = Path(__file__).resolve().parent.parent
    ran = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    assert "not registered" in ran.stderr
