"""File and table sources and sinks, checked by reading back."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.contract import adopt, publish
from tidemark.functions import payload
from tidemark.operators import retain, viewership
from tidemark.queries.binding import activity_of
from tidemark.queries.registry import query
from tidemark.session import scratch_path
from tidemark.sinks import files, tables
from tidemark.sources import catalog, landed

_SAMPLES = "SELECT ts AS timestamp, app_id, title, player_count, is_free{0} FROM raw_activity"


def _samples(m):
    return m.raw_activity.select(F.col("ts").alias("timestamp"), "app_id", "title", "player_count", "is_free")


@query("derive_partitions", _SAMPLES.format(", CAST(ts AS DATE) AS date, app_id AS game_id"))
def _(m):
    return files.derive_partitions(_samples(m))


def _saved(m, cols):
    path = scratch_path(m.spark, "samples")
    rows = _samples(m)
    files.save_samples(rows, path, cols)
    return landed.scan_partitioned(m.spark, path, files.derive_partitions(rows).schema)


@query("scan_raw_partitioned", _SAMPLES.format(", CAST(ts AS DATE) AS date, app_id AS game_id"))
def _(m):
    return _saved(m, ["date"])


@query("write_partitioned", _SAMPLES.format(", CAST(ts AS DATE) AS date, app_id AS game_id"))
def _(m):
    return _saved(m, ["date", "is_free"]).select("timestamp", "app_id", "title", "player_count", "is_free", "date", "game_id")


@query("write_flat", _SAMPLES.format(", CAST(ts AS DATE) AS date, app_id AS game_id"))
def _(m):
    return _saved(m, None)


@query(
    "validate_batch",
    """SELECT 'valid' AS batch, 'accepted' AS outcome, COUNT(*) AS records FROM raw_activity
       UNION ALL SELECT 'no count', 'Missing required column: player_count', COUNT(*) FROM raw_activity
       UNION ALL SELECT 'text id', 'app_id must be integer type', COUNT(*) FROM raw_activity
       UNION ALL SELECT 'empty', 'Cannot save empty data', 0""",
)
def _(m):
    rows = _samples(m)
    batches = {
        "valid": rows,
        "no count": rows.drop("player_count"),
        "text id": rows.withColumn("app_id", F.col("app_id").cast("string")),
        "empty": rows.where(F.col("player_count") < 0),
    }
    report = None
    for name, batch in batches.items():
        try:
            files.validate_batch(batch)
            outcome = "accepted"
        except (TypeError, ValueError) as error:
            outcome = str(error)
        line = batch.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("batch"), F.lit(outcome).alias("outcome"), "records"
        )
        report = line if report is None else report.unionByName(line)
    return report


@query(
    "export_json_records",
    """SELECT event_id, STRFTIME(ts, '%Y-%m-%dT%H:%M:%S.%g') AS ts,
              STRFTIME(CAST(ts AS DATE), '%Y-%m-%dT00:00:00.000') AS date,
              CASE WHEN k = 7 THEN NULL ELSE value END AS value, CASE WHEN k > 50 THEN event_type END AS event_type
       FROM ev""",
)
def _(m):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = m.table("events").select(
        "event_id", "ts", F.to_date("ts").alias("date"),
        F.when(k == 7, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(k > 50, F.col("event_type")).alias("event_type"),
    )
    path = scratch_path(m.spark, "records")
    name = f"records_{uuid.uuid4().hex}"
    catalog.register(rows, name)
    files.export_records(m.spark, path, query=f"SELECT * FROM {name}")
    catalog.unregister(m.spark, name)
    shape = "event_id BIGINT, ts STRING, date STRING, value DOUBLE, event_type STRING"
    return landed.scan_json(m.spark, path, shape)


def _fresh(prefix):
    return f"{prefix}_{uuid.uuid4().hex}"


@query("append_table", "SELECT ts, app_id, title, player_count FROM raw_activity")
def _(m):
    """Clicks create the table, views are appended with another column order."""
    columns = ["ts", "app_id", "title", "player_count"]
    name, path = _fresh("appended"), scratch_path(m.spark, "appended")
    tables.append_table(activity_of(m.events("click")).select(*columns), name, path)
    tables.append_table(activity_of(m.events("view")).select(*reversed(columns)), name)
    schema = m.spark.table(name).schema
    m.spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return landed.scan_partitioned(m.spark, path, schema)


@query("ctas_if_absent", "SELECT ts, channel_id, viewer_count FROM raw_viewers")
def _(m):
    name, path = _fresh("created"), scratch_path(m.spark, "created")
    rows = m.raw_viewers.select("ts", "channel_id", "viewer_count")
    tables.ctas_if_absent(rows, name, path)
    tables.ctas_if_absent(rows.where(F.col("viewer_count") < 0), name, path)  # no effect
    m.spark.sql(f"DROP TABLE {name}")
    return landed.scan_partitioned(m.spark, path, rows.schema)


_FILLED = {
    "raw_activity": "raw_activity", "raw_viewers": "raw_viewers", "raw_ratings": "raw_ratings",
    "worklist": "worklist", "dimension": "dim",
    "hourly_activity": "hourly_activity", "daily_activity": "daily_activity",
    "daily_viewers": "daily_viewers", "ratings_daily": "ratings_daily",
}


@query(
    "empty_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {len(s)} AS columns, "
        + (f"(SELECT COUNT(*) FROM {_FILLED[t]})" if t in _FILLED else "0") + " AS records"
        for t, s in schemas.TABLES.items()
    ),
)
def _(m):
    """Create all typed tables, fill the ones with bound data, count all."""
    prefix, root = f"t{uuid.uuid4().hex}_", scratch_path(m.spark, "typed")
    created = tables.create_empty_tables(m.spark, schemas.TABLES, root, prefix)
    for table, frame in _FILLED.items():
        bound = getattr(m, frame)
        tables.append_table(bound() if callable(bound) else bound, prefix + table)
    report = None
    for full in created:
        rows = m.spark.read.schema(m.spark.table(full).schema).parquet(f"{root}/{full}")
        line = rows.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(full.removeprefix(prefix)).alias("table_name"), F.lit(len(rows.columns)).alias("columns"), "records"
        )
        report = line if report is None else report.unionByName(line)
        m.spark.sql(f"DROP TABLE {full}")
    return report


@query("scan_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(m):
    name = _fresh("orders")
    catalog.register(m.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), name)
    rows = catalog.scan_table(m.spark, name)
    catalog.unregister(m.spark, name)
    return rows


@query(
    "adhoc_sql",
    """SELECT title, COUNT(*) AS samples, MAX(player_count) AS peak FROM raw_activity
       WHERE player_count > 5000 GROUP BY title""",
)
def _(m):
    return catalog.query(
        m.spark,
        """SELECT title, COUNT(*) AS samples, MAX(player_count) AS peak FROM {raw}
           WHERE player_count > 5000 GROUP BY title ORDER BY peak DESC""",
        raw=m.raw_activity,
    )


@query("register_frame", "SELECT channel_id, COUNT(*) AS samples FROM raw_viewers GROUP BY channel_id")
def _(m):
    name = _fresh("frame")
    catalog.register(m.raw_viewers, name)
    rows = m.spark.sql(f"SELECT channel_id, COUNT(*) AS samples FROM {name} GROUP BY channel_id")
    catalog.unregister(m.spark, name)
    return rows


@query(
    "table_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, {i} AS ordinal_position, COUNT({c}) AS present FROM raw_activity"
        for i, (c, t) in enumerate(
            [(f.name, f.dataType.simpleString()) for f in schemas.TABLES["raw_activity"]], 1
        )
    ),
)
def _(m):
    """Columns of a registered table, with the number of values present."""
    name = _fresh("columns")
    rows = catalog.register(m.raw_activity, name)
    listing = catalog.table_columns(m.spark, name)
    catalog.unregister(m.spark, name)
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    tall = counts.unpivot([], rows.columns, "column_name", "present")
    return listing.join(tall, "column_name")


def _report_sql(files, records, broken):
    names = ("files", "records", "broken_files", "broken_records", "keyless_records")
    counts = dict(zip(names, (files, records, broken, broken, "SELECT 0")))
    return " UNION ALL ".join(f"SELECT '{n}' AS figure, CAST(({q}) AS BIGINT) AS value" for n, q in counts.items())


def _figures(report):
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).alias("value")) for c in report.columns]))
    return report.select(pairs.alias("p")).select("p.*")


@query(
    "scan_landed_metadata",
    f"""SELECT p_partkey AS app_id, p_name AS name, free_flag AS is_free,
              CASE WHEN p_size >= 5 THEN p_brand ELSE '' END AS developers,
              CASE WHEN free_flag OR p_brand = 'Brand#1' THEN 0 ELSE (cents - p_size * 10) / 100 END AS price,
              NULL AS figure, NULL AS value
       FROM store_base WHERE p_size <> 7
       UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, figure, value FROM ({_report_sql(
           "SELECT COUNT(*) FROM store_base", "SELECT COUNT(*) FROM store_base WHERE p_size <> 7",
           "SELECT COUNT(*) FROM store_base WHERE p_size = 7")}) r""",
)
def _(m):
    """One indented object per file; the files of one size are cut off in the middle."""
    path = scratch_path(m.spark, "metadata")
    rows = payload.store_metadata(m.store_landed).join(m.table("part").select(F.col("p_partkey").alias("app_id"), "p_size"), "app_id")
    text = files.pretty(F.struct(*[c for c in rows.columns if c != "p_size"]))
    cut = F.when(F.col("p_size") == 7, F.left(text, (F.length(text) / 2).cast("int"))).otherwise(text)
    files.write_documents(rows.select(cut.alias("value")), path)
    scanned = landed.stage_whole(m.spark, path, landed.METADATA_SCHEMA)
    found = landed.sound(scanned).select(
        "app_id", "name", "is_free", F.array_join("developers", "|").alias("developers"),
        F.col("price_info.price").alias("price"),
    )
    return found.unionByName(_figures(landed.scan_report(scanned)), allowMissingColumns=True)


@query(
    "scan_landed_viewership",
    f"""SELECT p.p_partkey AS app_id, CAST(p.p_partkey AS VARCHAR) AS channel_id,
              CAST(COALESCE(SUM(s.viewer_count), 0) AS BIGINT) AS viewer_count, COUNT(s.channel_id) AS channel_count,
              COUNT(CASE WHEN s.n <= 3 THEN 1 END) AS leaders, NULL AS figure, NULL AS value
       FROM part p LEFT JOIN streams_ranked s ON s.channel_id = CAST(p.p_partkey AS VARCHAR)
       WHERE p.p_size <> 7 GROUP BY 1, 2
       UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, figure, value FROM ({_report_sql(
           "SELECT COUNT(DISTINCT p_size) FROM part", "SELECT COUNT(*) FROM part WHERE p_size <> 7",
           "SELECT COUNT(DISTINCT p_size) FROM part WHERE p_size = 7")}) r""",
)
def _(m):
    """One array per file, a file per size of part; one file is no JSON."""
    path = scratch_path(m.spark, "viewership")
    rows = publish(viewership.viewership(m.requested, m.streams))
    sized = rows.join(m.table("part").select(F.col("p_partkey").alias("steam_app_id"), "p_size"), "steam_app_id")
    record = F.struct(*[c for c in sized.columns if c != "p_size"])
    arrays = sized.groupBy("p_size").agg(files.pretty(F.collect_list(record)).alias("text"))
    broken = F.when(F.col("p_size") == 7, F.concat(F.lit("<html>"), "text")).otherwise(F.col("text"))
    files.write_documents(arrays.select(broken.alias("value")), path)
    scanned = landed.stage_whole(m.spark, path, landed.VIEWERSHIP_SCHEMA)
    found = adopt(landed.sound(scanned), "raw_viewers").select(
        "app_id", "channel_id", "viewer_count", "channel_count",
        F.size("top_streams").cast("bigint").alias("leaders"),
    )
    return found.unionByName(_figures(landed.scan_report(scanned)), allowMissingColumns=True)


def _later(days):
    return datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(days=days)


@query("file_retention_plan")
def _(m):
    """Freshly written files seen from eight days on."""
    path = scratch_path(m.spark, "old-files")
    files.save_samples(_samples(m), path, ["date"])
    return retain.file_retention_plan(m.spark, path, _later(8), 7)


@query("file_retention_summary")
def _(m):
    path = scratch_path(m.spark, "old-files")
    files.save_samples(_samples(m), path, ["date"])
    return retain.file_retention_summary(retain.file_retention_plan(m.spark, path, _later(40), 30))

