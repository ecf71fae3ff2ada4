import json
import os
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fareline.operators.upsert import merge_into
from fareline.operators.upsert import table_changes
from fareline.sources import storage, tables
from fareline.sources.json_files import bronze_files, evolve, infer_schema, parse, read_lines, variant_fields
from fareline.sources.landing import land, landed_files, landed_folder, read_manifest
from fareline.sources.tables import KeyedTable, create_namespaces, rebuild, rebuild_table
from fareline.streaming.flows import FileTable

DDL = "ride_id string, date_key date, fare double, seen timestamp"
T0 = datetime(2026, 1, 1)


def ride(ride_id, month, fare, day=0):
    return (ride_id, date(2025, month, 3), fare, T0 + timedelta(days=day))


@pytest.fixture
def table(tmp_path):
    return KeyedTable(str(tmp_path / "fact"), "ride_id", "date_key", ("seen",))


def content(table, spark):
    return {r.ride_id: (r.date_key and r.date_key.month, r.fare) for r in table.read(spark).collect()}


def month_files(table):
    """Month -> names of its files."""
    return {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in Path(table.root, "data").glob("_month=*")}


def test_merge_twice_gives_the_same_table(spark, rows, table):
    batch = rows([ride("a", 1, 1.0), ride("b", 2, 2.0)], DDL)
    assert table.is_empty(spark)
    with pytest.raises(ValueError, match="nothing has been merged"):
        table.read(spark)
    assert table.merge(batch) == 2 and not table.is_empty(spark)
    first, files = content(table, spark), month_files(table)
    assert table.merge(batch) == 0  # nothing differs
    assert content(table, spark) == first == {"a": (1, 1.0), "b": (2, 2.0)}
    assert month_files(table) == files


def test_merge_moves_rows_between_months_and_leaves_others_alone(spark, rows, table):
    table.merge(rows([ride("a", 1, 1.0), ride("b", 2, 2.0), ride("c", 3, 3.0), ("d", None, 4.0, T0)], DDL))
    before, files = rows([tuple(r) for r in table.read(spark).collect()], DDL), month_files(table)
    assert table.merge(rows([ride("a", 2, 9.0)], DDL)) == 1
    assert content(table, spark) == {"a": (2, 9.0), "b": (2, 2.0), "c": (3, 3.0), "d": (None, 4.0)}
    # January is empty now, February rewritten, March and the undated rows untouched.
    now = month_files(table)
    assert set(now) == {"_month=202502", "_month=202503", "_month=0"}
    assert now["_month=202503"] == files["_month=202503"] and now["_month=0"] == files["_month=0"]
    assert now["_month=202502"] != files["_month=202502"]
    changed = {(r.ride_id, r._change_type, r.fare) for r in table_changes(before, table.read(spark), "ride_id").collect()}
    assert changed == {("a", "update_preimage", 1.0), ("a", "update_postimage", 9.0)}


def test_merge_keeps_the_newest_of_a_batch(spark, rows, table):
    table.merge(rows([ride("a", 1, 1.0, 0), ride("a", 1, 2.0, 5), ride("a", 1, 3.0, 2)], DDL))
    assert content(table, spark) == {"a": (1, 2.0)}


def test_empty_batch_changes_nothing(spark, rows, table):
    table.merge(rows([ride("a", 1, 1.0)], DDL))
    assert table.merge(rows([], DDL)) == 0
    assert content(table, spark) == {"a": (1, 1.0)}


def test_a_first_load_isnt_staged(spark, rows, table):
    assert table.merge(rows([], DDL)) == 0 and table.is_empty(spark)
    assert table.merge(rows([ride("a", 1, 1.0), ride("a", 1, 2.0, 5), ride("b", 2, 3.0)], DDL)) == 2
    assert content(table, spark) == {"a": (1, 2.0), "b": (2, 3.0)}
    assert not Path(table.root, "batch").exists()


def test_a_first_load_compares_rows_of_repeated_keys_only(spark, rows, table, monkeypatch):
    """Rows without a key count as one key, here and among those compared."""
    compared = []

    def spy(batch, key, newest):
        compared.append(batch.count())
        return keep(batch, key, newest)

    keep = tables.keep_newest
    monkeypatch.setattr(tables, "keep_newest", spy)
    unnamed = [(None, date(2025, 4, 3), fare, T0 + timedelta(days=day)) for fare, day in ((5.0, 1), (6.0, 2))]
    batch = [ride("a", 1, 1.0), ride("a", 2, 2.0, 5), ride("b", 2, 3.0), ride("c", 2, 4.0), *unnamed]
    assert table.merge(rows(batch, DDL)) == 4 and compared == [4]
    assert content(table, spark) == {"a": (2, 2.0), "b": (2, 3.0), "c": (2, 4.0), None: (4, 6.0)}
    other = KeyedTable(f"{table.root}-2", "ride_id", "date_key", ("seen",))
    assert other.merge(rows(batch[2:5], DDL)) == 3 and compared == [4]
    assert not Path(table.root, "repeated").exists() and not Path(other.root, "repeated").exists()


def test_a_merge_cut_short_is_healed_by_its_repetition(spark, rows, table, monkeypatch):
    """The moved row has been written, its old month not yet removed."""
    table.merge(rows([ride("a", 1, 1.0), ride("b", 2, 2.0)], DDL))
    with monkeypatch.context() as cut:
        cut.setattr("fareline.sources.tables.remove", lambda spark, path: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(rows([ride("a", 2, 7.0)], DDL))
    assert table.read(spark).where("ride_id = 'a'").count() == 2
    table.merge(rows([ride("a", 2, 7.0)], DDL))
    assert table.read(spark).count() == 2 and content(table, spark) == {"a": (2, 7.0), "b": (2, 2.0)}


def test_new_columns_are_appended(spark, rows, table):
    table.merge(rows([ride("a", 1, 1.0), ride("b", 2, 2.0)], DDL))
    table.merge(rows([ride("a", 1, 5.0)], DDL).withColumn("promo", F.lit("P1")).drop("fare"))
    found = {r.ride_id: (r.fare, r.promo) for r in table.read(spark).collect()}
    assert found == {"a": (None, "P1"), "b": (2.0, None)}


def test_merge_into_reaches_the_table_format(spark, rows):
    """Parquet tables refuse row-level changes; the statement must get as far as that."""
    rows([("a", 1)], "ride_id string, v int").write.mode("overwrite").saveAsTable("merge_target")
    with pytest.raises(Exception, match="MERGE"):
        merge_into("merge_target", rows([("a", 2)], "ride_id string, v int"), "ride_id")
    spark.sql("DROP TABLE merge_target")


def test_namespaces_and_rebuilt_tables(spark, rows, tmp_path):
    create_namespaces(spark, str(tmp_path))
    create_namespaces(spark, str(tmp_path))
    assert {"bronze", "silver", "gold"} <= {r.namespace for r in spark.sql("SHOW SCHEMAS").collect()}
    for values in ([(1,), (2,)], [(3,)]):
        rebuild_table(rows(values, "v int"), "gold.numbers")
        rebuild(rows(values, "v int"), str(tmp_path / "numbers"))
    assert [r.v for r in spark.read.table("gold.numbers").collect()] == [3]
    assert spark.read.parquet(str(tmp_path / "numbers")).count() == 1
    spark.sql("DROP TABLE gold.numbers")


SCHEMA_DDL = "id int, name string, ok boolean"


def parsed(spark, rows, *lines):
    schema = rows([], SCHEMA_DDL).schema
    return [tuple(r) for r in parse(rows([(line,) for line in lines], "value string"), schema).collect()]


def test_rescue_keeps_everything_that_does_not_fit(spark, rows):
    assert parsed(spark, rows, '{"id":1,"name":"a","ok":true}', '{"id":2}', '{"name":null}') == [
        (1, "a", True, None), (2, None, None, None), (None, None, None, None),
    ]
    (_, name, _, rescued), = parsed(spark, rows, '{"id":"one","name":"a","extra":{"x":[1]},"ok":1.5}')
    assert name == "a"
    assert json.loads(rescued) == {"id": "one", "extra": '{"x":[1]}', "ok": "1.5"}
    assert parsed(spark, rows, '{"id":1, broken') == [(None, None, None, '{"_corrupt_record":"{\\"id\\":1, broken"}')]


def test_fitted_names_are_listed_once_a_record(spark, rows):
    """Not once for each of its fields, which takes the square of their number."""
    schema = spark.createDataFrame([], "id int, name string").schema
    rescued = parse(rows([('{"id":"x","id":"y","name":null,"z":1,"n":null}',)], "value string"), schema)
    assert json.loads(rescued.first()["_rescued_data"], object_pairs_hook=list) == [("id", "x"), ("id", "y"), ("z", "1")]
    plan = rescued._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains(lambda " in plan and "array_contains(array_compact" not in plan


def test_lines_may_hold_arrays_of_records(spark, rows):
    found = parsed(spark, rows, '[{"id":1},{"id":2,"z":0}]', "", '{"id":3}', '[{"id":4}')
    assert [r[0] for r in found] == [1, 2, 3, None]
    assert [r[3] for r in found] == [None, '{"z":"0"}', None, '{"_corrupt_record":"[{\\"id\\":4}"}']


def test_evolution_adds_but_never_retypes(rows):
    stored = rows([], "a int, b string").schema
    grown = evolve(stored, rows([], "b bigint, c double").schema)
    assert grown == rows([], "a int, b string, c double").schema


def test_bronze_rows_carry_their_origin(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text('[{"id":1},{"id":2}]')
    lines = read_lines(spark, str(tmp_path / "in"))
    found = bronze_files(lines, rows([], "id int").schema).collect()
    assert {r.id for r in found} == {1, 2}
    assert all(r._source_file.endswith("one.json") and r._source_modified_at and r._ingested_at for r in found)
    assert len({r._batch_id for r in found}) == 2


def test_file_table_reads_each_file_once_and_grows(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    table = FileTable(str(tmp_path / "bronze"), str(folder))
    with pytest.raises(ValueError, match="no file"):
        table.schema(spark)
    (folder / "1.json").write_text('{"id":1,"v":10}\n{"id":2,"v":20}\n')
    table.start(spark).awaitTermination()
    table.start(spark).awaitTermination()
    assert table.read(spark).count() == 2
    # A new field becomes a column at once; a mistyped one is rescued, as types stay.
    (folder / "2.json").write_text('{"id":3,"v":"n/a","w":true}\n')
    table.start(spark).awaitTermination()
    (late,) = table.read(spark).where("id = 3").collect()
    assert late.v is None and late.w is True and json.loads(late._rescued_data) == {"v": "n/a"}
    (folder / "3.json").write_text('{"id":4,"v":40,"w":false}\n')
    table.start(spark, max_files=1).awaitTermination()
    assert {(r.id, r.v, r.w) for r in table.read(spark).collect()} == {(1, 10, None), (2, 20, None), (3, None, True), (4, 40, False)}


def test_types_come_from_one_aggregate_over_the_lines(spark, rows):
    lines = [
        '{"id":1,"price":1.25,"nothing":null,"mixed":1,"deep":{"x y":[1,2.5],"VOID":true}}',
        '[{"id":2,"mixed":"a"},{"id":3,"OBJECT":{}}]',
        '{"id":4, broken', "17", "", '{"VARIANT":"t","a`b":1e3}',
    ]
    found = infer_schema(rows([(line,) for line in lines], "value string"))
    assert {f.name: f.dataType.simpleString() for f in found} == {
        "id": "bigint", "price": "double", "nothing": "string", "mixed": "string", "VARIANT": "string",
        "deep": "struct<VOID:boolean,x y:array<double>>", "OBJECT": "struct<>", "a`b": "double",
    }
    assert variant_fields("VOID") == variant_fields("ARRAY<BIGINT>") == rows([(1,)], "v int").drop("v").schema


def test_small_files_of_a_batch_become_one(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for n in range(50):
        (folder / f"{n}.json").write_text(f'{{"id":{n}}}\n')
    table = FileTable(str(tmp_path / "bronze"), str(folder))
    table.start(spark).awaitTermination()
    assert table.read(spark).count() == 50
    assert len(list((tmp_path / "bronze" / "data").rglob("*.parquet"))) == 1


def test_landing_follows_the_manifest(spark, tmp_path):
    files, raw = tmp_path / "files", str(tmp_path / "raw")
    files.mkdir()
    (files / "map_cities.json").write_text('[{"city_id":1}]')
    (files / "bulk.json").write_text('{"ride_id":"a"}\n{"ride_id":"b"}\n')
    manifest = tmp_path / "files_list.json"
    entries = [("map_cities.", "map_cities.json"), ("bulk_rides", "bulk.json")]
    manifest.write_text(json.dumps([{"folder_name": d, "file_name": f} for d, f in entries]))
    land(spark, read_manifest(spark, str(manifest)), str(files), raw)
    assert spark.read.json(landed_folder(raw, "map_cities")).count() == 1
    assert spark.read.json(landed_folder(raw, "bulk_rides")).count() == 2
    # Landing one folder again replaces it and leaves the other.
    (files / "map_cities.json").write_text('[{"city_id":1},{"city_id":2}]')
    manifest.write_text(json.dumps([{"folder_name": "map_cities.", "file_name": "map_cities.json"}]))
    land(spark, read_manifest(spark, str(manifest)), str(files), raw)
    assert spark.read.json(landed_folder(raw, "map_cities")).count() == 2
    assert spark.read.json(landed_folder(raw, "bulk_rides")).count() == 2


def test_landing_twice_writes_changed_files_only(spark, tmp_path):
    files, raw, root = tmp_path / "files", str(tmp_path / "raw"), str(tmp_path / "bronze")
    (files / "parts").mkdir(parents=True)
    for name, text in (("a.json", '{"n":1}\n{"n":2}\n'), ("b.json", '{"n":3}\n'), ("parts/1", '{"n":4}\n'), ("parts/2", '{"n":5}\n')):
        (files / name).write_text(text)
    manifest = tmp_path / "files_list.json"

    def land_these(*names):
        manifest.write_text(json.dumps([{"folder_name": "all", "file_name": name} for name in names]))
        log = land(spark, read_manifest(spark, str(manifest)), str(files), raw)
        bronze.start(spark).awaitTermination()
        return sorted((r.file_name, r.lines) for r in log.collect())

    def landed():
        return sorted(r.n for r in spark.read.schema("n int").json(landed_folder(raw, "all")).collect())

    def arrived():
        return sorted(r.n for r in bronze.read(spark).collect())

    bronze = FileTable(root, landed_folder(raw, "all"))
    everything = ("a.json", "b.json", "parts")
    (tmp_path / "raw" / "folder_name=all").mkdir(parents=True)
    assert land_these(*everything) == [("a.json", 2), ("b.json", 1), ("parts", 2)]
    assert landed() == arrived() == [1, 2, 3, 4, 5]
    # The same lines in another order, or touched, are the same file.
    (files / "a.json").write_text('{"n":2}\n{"n":1}\n')
    assert land_these(*everything) == []
    assert landed() == arrived() == [1, 2, 3, 4, 5]
    # One changed file brings its rows, no others.
    (files / "b.json").write_text('{"n":3}\n{"n":30}\n')
    assert land_these(*everything) == [("b.json", 2)]
    assert landed() == [1, 2, 3, 4, 5, 30] and arrived() == [1, 2, 3, 3, 4, 5, 30]
    # One emptied and one not listed any more are cleared; the stream gets nothing.
    (files / "a.json").write_text("")
    assert land_these("a.json", "parts") == [("a.json", 0), ("b.json", 0)]
    assert landed() == [4, 5] and len(arrived()) == 7
    assert land_these("a.json", "parts") == []
    # One that comes back is landed again, with a repeated line counted as such.
    (files / "a.json").write_text('{"n":9}\n{"n":9}\n')
    assert land_these(*everything) == [("a.json", 2), ("b.json", 2)]
    assert landed() == [3, 4, 5, 9, 9, 30]
    assert {r.file_name: r.lines for r in landed_files(spark, raw).collect()} == {"a.json": 2, "b.json": 2, "parts": 2}


def test_landed_lines_are_compressed_in_parts_of_bounded_length(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "PART_LINES", 300)
    files, raw = tmp_path / "files", str(tmp_path / "raw")
    files.mkdir()
    lines = [json.dumps({"n": n, "vehicle_model": "Corolla", "vehicle_color": "Black"}) for n in range(1000)]
    (files / "bulk.json").write_text("\n".join(lines))
    land(spark, rows([("all", "bulk.json")], "folder_name string, file_name string"), str(files), raw)
    parts = list(Path(landed_folder(raw, "all")).rglob("part-*"))
    assert len(parts) >= 4 and sum(p.stat().st_size for p in parts) < (files / "bulk.json").stat().st_size / 2
    assert sorted(r.value for r in read_lines(spark, landed_folder(raw, "all")).collect()) == sorted(lines)


def test_landing_a_missing_file_fails(spark, rows, tmp_path):
    manifest = rows([("a", "nowhere.json")], "folder_name string, file_name string")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        land(spark, manifest, str(tmp_path), str(tmp_path / "raw"))


def test_landing_takes_any_name_and_clears_emptied_folders(spark, tmp_path):
    files, raw = tmp_path / "fi les", str(tmp_path / "raw")
    (files / "sub").mkdir(parents=True)
    names = ["plain.json", "with space.json", "100%+.json", "sub/nested.json", "odd[1].json"]
    for name in names:
        (files / name).write_text('{"n":1}\n')
    manifest = tmp_path / "files_list.json"
    manifest.write_text(json.dumps([{"folder_name": "all", "file_name": name} for name in names]))
    land(spark, read_manifest(spark, str(manifest)), str(files), raw)
    found = spark.read.option("recursiveFileLookup", "true").text(landed_folder(raw, "all"))
    assert found.count() == 5
    assert {r.file_name for r in spark.read.text(raw).select("file_name").collect()} == set(names)
    for name in names:
        (files / name).write_text("")
    land(spark, read_manifest(spark, str(manifest)), str(files), raw)
    assert spark.read.schema("value string").option("recursiveFileLookup", "true").text(landed_folder(raw, "all")).isEmpty()


def test_merge_settles_equal_stamps(spark, rows, table):
    twice = [ride("a", 1, fare) for fare in (3.0, 1.0, 2.0)]
    table.merge(rows(twice, DDL))
    assert content(table, spark) == {"a": (1, 3.0)}
    assert table.merge(rows(twice[::-1], DDL)) == 0


def test_old_files_bring_their_columns(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    table = FileTable(str(tmp_path / "bronze"), str(folder))
    (folder / "1.json").write_text('{"id":1}\n')
    table.start(spark).awaitTermination()
    old = folder / "2.json"
    old.write_text('{"id":2,"w":true}\n')
    os.utime(old, (old.stat().st_mtime - 864_000,) * 2)
    table.start(spark).awaitTermination()
    assert {(r.id, r.w) for r in table.read(spark).collect()} == {(1, None), (2, True)}
