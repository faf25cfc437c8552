import os
import time
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import contract, schemas
from tidemark.operators import retain
from tidemark.plans import exports
from tidemark.sinks import files, tables
from tidemark.sources import catalog, landed

SAMPLE = "app_id int, game_name string, player_count int, timestamp string"
ROW = (730, "Counter-Strike 2", 1000000, "2025-01-22T14:30:00+00:00")


def test_partition_columns(rows, got):
    frame = files.derive_partitions(rows(SAMPLE.replace("timestamp string", "`timestamp` string"), ROW))
    assert got(frame, "date", "game_id") == [(date(2025, 1, 22), 730)]


def test_partitioned_and_flat_writes(spark, rows, got, tmp_path):
    batch = rows(SAMPLE, ROW, (570, "Dota 2", 5, "2025-01-23T00:00:00+00:00"))
    target = tmp_path / "p"
    files.save_samples(batch, str(target), ["date", "game_id"])
    assert (target / "date=2025-01-22" / "game_id=730").is_dir()
    schema = files.derive_partitions(batch).schema
    back = landed.scan_partitioned(spark, str(target), schema)
    assert got(back, "app_id", "date", "game_id") == [(570, date(2025, 1, 23), 570), (730, date(2025, 1, 22), 730)]
    files.save_samples(batch, str(target), ["date", "game_id"])  # appends
    assert back.sparkSession.read.parquet(str(target)).count() == 4
    files.save_samples(batch, str(tmp_path / "flat"))
    assert spark.read.parquet(str(tmp_path / "flat")).count() == 2


def test_bad_batches(rows):
    good = rows(SAMPLE, ROW)
    for name in ("app_id", "player_count", "timestamp"):
        with pytest.raises(ValueError, match=name):
            files.validate_batch(good.drop(name))
    for name in ("app_id", "player_count"):
        with pytest.raises(TypeError):
            files.validate_batch(good.withColumn(name, F.col(name).cast("string")))
    with pytest.raises(ValueError, match="empty"):
        files.validate_batch(good.where("false"))


def test_export_needs_exactly_one_source(spark):
    with pytest.raises(ValueError):
        files.export_records(spark, "/nowhere")
    with pytest.raises(ValueError):
        files.export_records(spark, "/nowhere", table_name="t", query="SELECT 1")


def test_append_is_by_name(spark, rows, got, tmp_path):
    name = f"t{os.getpid()}_{time.time_ns()}"
    tables.append_table(rows("a long, b string", (1, "x")), name, str(tmp_path / "t"))
    tables.append_table(rows("b string, a long", ("y", 2)), name)
    assert got(catalog.scan_table(spark, name), "a", "b") == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        tables.append_table(rows("a long, c string", (3, "z")), name)
    assert not tables.ctas_if_absent(rows("a long, b string", (9, "q")), name)
    assert [r.column_name for r in catalog.table_columns(spark, name).orderBy("ordinal_position").collect()] == ["a", "b"]
    spark.sql(f"DROP TABLE {name}")


def test_typed_tables(spark, tmp_path):
    assert len(schemas.TABLES) == 18 and schemas.KEYS.keys() == schemas.TABLES.keys()
    assert len(schemas.TABLES["dimension"]) == 27
    # The states of the all-time figures are not published.
    assert contract.TABLE_NAMES.keys() == schemas.TABLES.keys() - {"activity_totals", "viewer_totals"}
    prefix = f"e{time.time_ns()}_"
    assert len(tables.create_empty_tables(spark, schemas.TABLES, str(tmp_path), prefix)) == 18
    assert tables.create_empty_tables(spark, schemas.TABLES, str(tmp_path), prefix) == []
    assert spark.table(prefix + "daily_viewers").schema.names == schemas.TABLES["daily_viewers"].names


def test_published_names_round_trip(spark):
    for table, schema in schemas.TABLES.items():
        frame = spark.createDataFrame([], schema)
        assert contract.adopt(contract.publish(frame, table), table).columns == frame.columns
    daily = contract.publish(spark.createDataFrame([], schemas.TABLES["daily_activity"]))
    assert {"igdb_id", "steam_app_id", "game_name", "avg_metacritic_score"} <= set(daily.columns)


def _tree(root, ages):
    for i, days in enumerate(ages):
        folder = root / f"date=2025-01-{i + 1:02d}" / "game_id=1"
        folder.mkdir(parents=True)
        target = folder / "f.parquet"
        target.write_bytes(b"x" * 10)
        stamp = time.time() - days * 86400
        os.utime(target, (stamp, stamp))
    (root / "notes.txt").write_text("keep")


def test_old_files(spark, tmp_path):
    _tree(tmp_path, [40, 35, 10, 5])
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    plan = retain.file_retention_plan(spark, str(tmp_path), now, 30)
    assert retain.file_retention_summary(plan).collect()[0].asDict() == {"files_deleted": 2, "bytes_freed": 20}
    report = retain.delete_old_files(spark, str(tmp_path), now, 30, dry_run=True)
    assert report == {"files_deleted": 2, "bytes_freed": 20} and len(list(tmp_path.rglob("*.parquet"))) == 4
    retain.delete_old_files(spark, str(tmp_path), now, 30, remove_empty_dirs=True)
    assert len(list(tmp_path.rglob("*.parquet"))) == 2
    assert not (tmp_path / "date=2025-01-01").exists() and (tmp_path / "notes.txt").exists()
    with pytest.raises(FileNotFoundError):
        retain.delete_old_files(spark, str(tmp_path / "none"), now)


def test_old_days_are_dropped_as_folders(spark, rows, tmp_path):
    frame = rows("date date, v long", *[(f"2025-01-{d:02d}", d) for d in range(1, 11)])
    frame.write.partitionBy("date").parquet(str(tmp_path / "t"))
    assert retain.drop_partitions_before(spark, str(tmp_path / "t"), "date", date(2025, 1, 4)) == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_retention_boundary(rows, got):
    raw = rows("ts timestamp_ntz, v long", ("2025-01-15 00:00:00", 1), ("2025-01-14 23:59:59", 2))
    assert got(retain.retain_raw(raw, date(2025, 1, 22)), "v") == [(1,)]
    assert got(retain.retention_counts(raw, "ts", date(2025, 1, 15))) == [(2, 1, 1)]
    hourly = rows("hour timestamp_ntz, v long", ("2025-01-15 12:00:00", 1), ("2025-01-15 13:00:00", 2))
    assert got(retain.retain_hourly(hourly, datetime(2025, 1, 22, 12, 30)), "v") == [(2,)]


def test_whole_files_with_broken_ones(spark, got, tmp_path):
    (tmp_path / "a.json").write_text('{\n  "app_id": 730,\n  "name": "CS",\n  "genres": ["Action"]\n}')
    (tmp_path / "b.json").write_text('{"app_id": 570, "name": "Do')
    (tmp_path / "c.json").write_text('{"name": "no id"}')
    (tmp_path / "d.json").write_text('[{"app_id": 1, "name": "x"}, {"app_id": "text", "name": "y"}, {"app_id": 2}]')
    rows = landed.scan_whole(spark, str(tmp_path), landed.METADATA_SCHEMA)
    (tmp_path / "e.json").write_text('[\n{"app_id": 1, "name": "x"},\n{"app_id": 2}\n]')
    assert got(landed.sound(rows), "app_id", "name") == [(730, "CS"), (None, "no id")]
    assert got(landed.scan_report(rows)) == [(4, 2, 2, 4, 1)]
    rows = landed.scan_whole(spark, str(tmp_path), landed.METADATA_SCHEMA)
    assert got(landed.sound(rows), "app_id", "name") == [(1, "x"), (2, None), (730, "CS"), (None, "no id")]
    assert landed.scan_metadata(spark, str(tmp_path)).columns == rows.columns[:-2]


def test_documents_are_one_file_each(spark, rows, tmp_path):
    frame = rows("id long, name string", *[(i, f"n{i}") for i in range(5)])
    files.write_documents(frame.select(files.pretty(F.struct("id", "name"))), str(tmp_path / "out"))
    texts = sorted(p.read_text() for p in (tmp_path / "out").glob("*.txt") if p.stat().st_size)
    assert len(texts) == 5 and all(t.count("\n") > 2 for t in texts)


def test_documents_of_one_partition_are_written_by_many_tasks(spark, got, tmp_path):
    frame = spark.range(0, 300, numPartitions=1).select(F.concat(F.lit("n"), "id").alias("value"))
    files.write_documents(frame, str(tmp_path / "out"))
    files.write_documents(frame.limit(1), str(tmp_path / "out"))  # appends
    found = [p for p in (tmp_path / "out").glob("*.txt") if p.stat().st_size]
    assert sorted(p.read_text() for p in found) == sorted([f"n{i}\n" for i in range(300)] + ["n0\n"])
    assert len({p.name.split("-")[1] for p in found}) > 4  # part-<task>-…
    assert not (tmp_path / "out" / "_temporary").exists()


def test_staged_scan_opens_each_file_once(spark, got, tmp_path):
    texts = {"a": '{"id": 1,\n"name": "x"}', "b": '[{"id": 2}, {"name": "y"}]', "c": '{"id": 3, "na', "d": '{"id": "text"}'}
    (tmp_path / "in").mkdir()
    for name, text in texts.items():
        (tmp_path / "in" / f"{name}.json").write_text(text)
    setting = "spark.sql.files.openCostInBytes"
    kept = spark.conf.get(setting)
    direct = landed.scan_whole(spark, str(tmp_path / "in"), "id bigint, name string")
    staged = landed.stage_whole(spark, str(tmp_path / "in"), "id bigint, name string")
    assert spark.conf.get(setting) == kept and staged.dtypes == direct.dtypes
    assert got(staged) == got(direct) and got(landed.scan_report(staged)) == [(4, 3, 2, 2, 1)]
    for p in (tmp_path / "in").iterdir():
        p.write_text("{}")  # what is read now comes from the stage
    assert got(landed.sound(staged)) == [(1, "x"), (2, None), (None, "y")]


def test_stored_json_text_is_decoded_or_kept(rows, tmp_path):
    import json

    values = ['["a", "b"]', '{"k": [1, null]}', "", "not json", '["open', None, "7", "null", '"quoted"']
    frame = rows("canonical_id long, title string, genres string", *[(i, "t", v) for i, v in enumerate(values)])
    files.write_records(exports.dimension(frame), str(tmp_path / "out"))
    lines = [json.loads(line) for p in (tmp_path / "out").glob("*.json") for line in p.read_text().splitlines()]

    def kept(text):  # the rule: decode non-empty text, keep what is no JSON
        try:
            return json.loads(text) if text else text
        except json.JSONDecodeError:
            return text

    assert {r["canonical_id"]: r["genres"] for r in lines} == {i: kept(v) for i, v in enumerate(values)}
