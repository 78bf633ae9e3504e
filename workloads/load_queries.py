"""Registered queries over loads, tables and their layout."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.functions.reports import field_profile
from landgate.functions.variant import to_variant, variant_fields
from landgate.operators.layout import files_touched, interleaved
from landgate.operators.quality import split_valid
from landgate.operators.tables import append_table, clustered, create_target, overwrite_table
from landgate.plans.incremental import load_new
from landgate.plans.load import LoadConfig, run_load
from landgate.schemas import TRADE, TargetColumn
from landgate.sources.json_records import read_json
from landgate.workspace import workspace
from workloads.landed import TRADES, TRADES_JUDGED, land_trades, trade_lines
from workloads.risk_queries import ALL
from workloads.risk_rows import risk_rows, risk_sql

DETAILS = {
    "order_type": ("$.order.order_type", "string"),
    "volume": ("$.market_data.volume", "bigint"),
    "beta": ("$.risk_metrics.beta", "double"),
    "volume_text": ("$.market_data.volume", "string"),
    "no_such": ("$.market_data.none", "string"),
    "wrong_type": ("$.order.order_type", "int"),
}


def _name(purpose: str) -> str:
    return f"{purpose}_{uuid.uuid4().hex}"


def read_and_drop(spark, name):
    """The rows of an external table; its entry in the catalog goes, its files stay."""
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def _loaded(spark, sf, times=1, **more):
    source = land_trades(spark, sf)
    cfg = LoadConfig(
        source, _name("trades"), table_path=workspace(spark, "trades-table"), **more
    )
    reports = [run_load(spark, cfg) for _ in range(times)]
    return read_and_drop(spark, cfg.table), reports


def load_twice(spark, sf):
    """The same landed files loaded twice under a ledger, and the rows that each run inserted."""
    cfg = LoadConfig(
        land_trades(spark, sf), _name("trades"), table_path=workspace(spark, "trades-table"), ledger=_name("ledger")
    )
    reports = [run_load(spark, cfg) for _ in range(2)]
    entered = spark.table(cfg.ledger).count()
    table = spark.read.schema(spark.table(cfg.table).schema).parquet(cfg.table_path)
    for name in (cfg.ledger, cfg.table):
        spark.sql(f"DROP TABLE {name}")
    inserted = [F.lit(r.inserted).cast("long").alias(f"inserted_{i}") for i, r in enumerate(reports, 1)]
    return table.select(
        F.col("RECORD_ID").alias("record_id"), F.col("QUANTITY").alias("quantity"), *inserted,
        F.lit(entered).cast("long").alias("batches"),
    )


def load_conform(spark, sf):
    table, _ = _loaded(spark, sf)
    return table.select(
        F.col("RECORD_ID").alias("record_id"),
        F.col("TRADE_DATE").alias("trade_date"),
        F.col("QUANTITY").alias("quantity"),
        F.col("PRICE").alias("price"),
        F.col("CURRENCY").alias("currency"),
        F.col("TRADE_DETAILS").isNotNull().alias("has_details"),
        (F.col("CREATED_AT") == F.col("LOAD_TIMESTAMP")).alias("stamped"),
    )


def load_variant_fields(spark, sf):
    table, _ = _loaded(spark, sf)
    return variant_fields(table, "TRADE_DETAILS", DETAILS, keep=("RECORD_ID",))


def load_append_count(spark, sf):
    table, reports = _loaded(spark, sf, times=2)
    last = reports[-1]
    return table.agg(
        F.lit(last.total).cast("bigint").alias("total"),
        F.lit(last.valid_count).cast("bigint").alias("valid"),
        F.lit(last.invalid_count).cast("bigint").alias("invalid"),
        F.lit(last.inserted).cast("bigint").alias("inserted"),
        F.count(F.lit(1)).alias("table_rows"),
        F.count_distinct("RECORD_ID").alias("record_ids"),
    )


def load_rejects(spark, sf):
    rejected = _name("rejected")
    _loaded(spark, sf, invalid_table=rejected, invalid_path=workspace(spark, "rejected"))
    return read_and_drop(spark, rejected).select(F.col("_corrupt_record").alias("rejected"))


def load_coerced(spark, sf):
    """Per target column, the values that did not fit and became NULL, as the audit row states them."""
    _, reports = _loaded(spark, sf)
    return reports[0].audit.select(F.inline("nulled")).filter("nulls > 0")


def load_check(spark, sf):
    """After a load: the rows of the table, and its first five."""
    table, _ = _loaded(spark, sf)
    first = table.select(F.col("RECORD_ID").alias("record_id"), F.col("QUANTITY").alias("quantity"))
    return first.orderBy("record_id").limit(5).withColumn("table_rows", F.lit(table.count()))


def load_overwrite_count(spark, sf):
    valid, _ = split_valid(read_json(spark, land_trades(spark, sf), TRADE, multiline=False))
    name, path = _name("replaced"), workspace(spark, "replaced")
    for _ in range(2):
        written, verified = overwrite_table(to_variant(valid, "trade_details"), name, path)
    return read_and_drop(spark, name).agg(
        F.lit(written).cast("bigint").alias("written"),
        F.lit(verified).cast("bigint").alias("verified"),
        F.count(F.lit(1)).alias("table_rows"),
    )


def audit(spark, sf):
    source, audit_table = land_trades(spark, sf), _name("audit")
    cfg = LoadConfig(source, _name("trades"), table_path=workspace(spark, "trades-table"))
    report = run_load(spark, cfg)
    append_table(report.audit, audit_table, workspace(spark, "audit"))
    spark.sql(f"DROP TABLE {cfg.table}")
    return read_and_drop(spark, audit_table).select(
        "total", "valid", "invalid", "inserted",
        "valid_pct", "invalid_pct",
    )


def landing_new(spark, sf):
    """Two thirds of the trade lines landed and loaded, then the rest, and then nothing: by which run each line
    came, and what the ledger says of all files and of the third run."""
    landing, rows = workspace(spark, "landing"), trade_lines(spark, sf)
    table, ledger = _name("lines"), _name("files")
    where = {"table_path": workspace(spark, "lines"), "ledger_path": workspace(spark, "files")}
    reports = []
    for lines in (rows.filter("k % 3 <> 0"), rows.filter("k % 3 = 0"), None):
        if lines is not None:
            lines.select("raw").write.mode("append").text(landing)
        reports.append(load_new(spark, landing, table, ledger, spark.read.text, max_files=5, **where))
    entered = spark.table(ledger).agg(
        F.sum("rows").alias("ledger_rows"), F.count_if(F.col("status") != "LANDED").alias("not_landed")
    ).first()
    by_run = F.when(F.col("batch_id").isin(list(reports[0].batches)), 1).when(F.col("batch_id").isin(list(reports[1].batches)), 2)
    lines = spark.read.schema(spark.table(table).schema).parquet(where["table_path"])
    for name in (ledger, table):
        spark.sql(f"DROP TABLE {name}")
    return lines.select(
        F.col("value").alias("raw"), by_run.alias("run"), F.lit(reports[2].rows + reports[2].landed).cast("long").alias("again"),
        *[F.lit(n).cast("long").alias(c) for c, n in entered.asDict().items()],
    )


def declared_insert(spark, sf):
    spec = (
        TargetColumn("cust_id", "bigint", "c_custkey", required=True),
        TargetColumn("name", "string", "c_name"),
        TargetColumn("created_at", "timestamp_ntz"),
    )
    name = _name("declared")
    create_target(spark, name, spec, workspace(spark, "declared"))
    create_target(spark, name, spec)
    spark.read.parquet(f"{sf}/customer.parquet").createOrReplaceTempView("_customer")
    spark.sql(f"INSERT INTO {name} (cust_id, name) SELECT c_custkey, c_name FROM _customer")
    return read_and_drop(spark, name).select(
        "cust_id", "name", F.col("created_at").isNotNull().alias("stamped")
    )


def clustered_table(spark, sf):
    name = _name("clustered")
    rows = clustered(
        risk_rows(spark, sf),
        ["effective_end_date", "identifier_type", "asset_class"],
        spread=["identifier", "metric_name", "effective_start_date", "k"],
    )
    append_table(rows, name, workspace(spark, "clustered"))
    return read_and_drop(spark, name)


#: The keys by which the risk table is laid out here; its rows carry no file name.
LAYOUT_KEYS = ("k", "effective_end_date", "identifier_type", "asset_class")
#: Files per layout that the two are compared with.
LAYOUT_FILES = 64


def _laid_out(spark, sf, layout, **more):
    where = workspace(spark, "layout")
    layout(risk_rows(spark, sf), LAYOUT_KEYS, **more).write.parquet(where)
    return spark.read.parquet(where)


def interleaved_table(spark, sf):
    return _laid_out(spark, sf, interleaved, spread=["identifier", "metric_name"])


def layout_pruned(spark, sf):
    """Files that a lookup of one value reaches, per key, in range order and along the curve."""
    ranged = files_touched(_laid_out(spark, sf, clustered, spread=["identifier"], partitions=LAYOUT_FILES), LAYOUT_KEYS)
    curve = files_touched(_laid_out(spark, sf, interleaved, partitions=LAYOUT_FILES), LAYOUT_KEYS)
    return (
        ranged.withColumnsRenamed({"files": "range_files", "touched": "range_touched"})
        .join(curve.withColumnsRenamed({"files": "curve_files", "touched": "curve_touched"}), "key")
    )


def schema_report(spark, sf):
    valid, _ = split_valid(read_json(spark, land_trades(spark, sf), TRADE, multiline=False))
    return field_profile(valid).select("path", "type", "present")


def _paths(schema, prefix=""):
    for f in schema.fields:
        if f.name == "_corrupt_record":
            continue
        yield prefix + f.name, f.dataType.simpleString()
        if isinstance(f.dataType, T.StructType):
            yield from _paths(f.dataType, f"{prefix}{f.name}.")


GOOD = f"{TRADES_JUDGED}, good AS (SELECT * FROM judged WHERE good) "

QUERIES = {
    "load_conform": (
        load_conform,
        GOOD
        + """SELECT json_extract_string(raw, '$.record_id') AS record_id,
            TRY_CAST(json_extract_string(raw, '$.trade_date') AS DATE) AS trade_date,
            CAST(CAST(json_extract_string(raw, '$.quantity') AS DOUBLE) AS DECIMAL(18, 4)) AS quantity,
            CAST(CAST(json_extract_string(raw, '$.price') AS DOUBLE) AS DECIMAL(18, 6)) AS price,
            json_extract_string(raw, '$.currency') AS currency,
            json_extract(raw, '$.trade_details') IS NOT NULL AS has_details, true AS stamped
            FROM good""",
    ),
    "load_variant_fields": (
        load_variant_fields,
        GOOD
        + """SELECT json_extract_string(raw, '$.record_id') AS RECORD_ID,
            json_extract_string(raw, '$.trade_details.order.order_type') AS order_type,
            CAST(json_extract_string(raw, '$.trade_details.market_data.volume') AS BIGINT) AS volume,
            CAST(json_extract_string(raw, '$.trade_details.risk_metrics.beta') AS DOUBLE) AS beta,
            json_extract_string(raw, '$.trade_details.market_data.volume') AS volume_text,
            CAST(NULL AS VARCHAR) AS no_such, CAST(NULL AS INTEGER) AS wrong_type
            FROM good""",
    ),
    "load_twice": (
        load_twice,
        TRADES_JUDGED
        + """SELECT json_extract_string(safe, '$.record_id') AS record_id,
            TRY_CAST(json_extract_string(safe, '$.quantity') AS DECIMAL(18, 4)) AS quantity,
            (SELECT count(*) FROM judged WHERE good) AS inserted_1, CAST(0 AS BIGINT) AS inserted_2,
            CAST(1 AS BIGINT) AS batches FROM judged WHERE good""",
    ),
    "load_append_count": (
        load_append_count,
        TRADES_JUDGED
        + """SELECT count(*) AS total, count(*) FILTER (good) AS valid,
            count(*) FILTER (NOT good) AS invalid, count(*) FILTER (good) AS inserted,
            2 * count(*) FILTER (good) AS table_rows, count(*) FILTER (good) AS record_ids
            FROM judged""",
    ),
    "load_coerced": (
        load_coerced,
        TRADES_JUDGED
        + """SELECT 'TRADE_DATE' AS field, count(*) AS nulls FROM judged
            WHERE good AND json_extract_string(safe, '$.trade_date') IS NOT NULL
              AND TRY_CAST(json_extract_string(safe, '$.trade_date') AS DATE) IS NULL HAVING count(*) > 0""",
    ),
    "load_check": (
        load_check,
        TRADES_JUDGED
        + """SELECT json_extract_string(raw, '$.record_id') AS record_id,
            CAST(json_extract_string(raw, '$.quantity') AS DECIMAL(18, 4)) AS quantity,
            (SELECT count(*) FROM judged WHERE good) AS table_rows
            FROM judged WHERE good ORDER BY record_id LIMIT 5""",
    ),
    "load_rejects": (
        load_rejects, TRADES_JUDGED + "SELECT raw AS rejected FROM judged WHERE NOT good"
    ),
    "load_overwrite_count": (
        load_overwrite_count,
        TRADES_JUDGED
        + """SELECT count(*) FILTER (good) AS written, count(*) FILTER (good) AS verified,
            count(*) FILTER (good) AS table_rows FROM judged""",
    ),
    "audit": (
        audit,
        TRADES_JUDGED
        + """SELECT count(*) AS total, count(*) FILTER (good) AS valid,
            count(*) FILTER (NOT good) AS invalid, count(*) FILTER (good) AS inserted,
            100.0 * CAST(count(*) FILTER (good) AS DOUBLE) / count(*) AS valid_pct,
            100.0 * CAST(count(*) FILTER (NOT good) AS DOUBLE) / count(*) AS invalid_pct
            FROM judged""",
    ),
    "landing_new": (
        landing_new,
        f"""SELECT raw, CASE WHEN k % 3 <> 0 THEN 1 ELSE 2 END AS run, CAST(0 AS BIGINT) AS again,
            (SELECT count(*) FROM orders) AS ledger_rows, CAST(0 AS BIGINT) AS not_landed FROM ({TRADES})""",
    ),
    "declared_insert": (
        declared_insert,
        "SELECT c_custkey AS cust_id, c_name AS name, true AS stamped FROM customer",
    ),
    "clustered_table": (clustered_table, risk_sql(f"SELECT {ALL} FROM risk")),
    "interleaved_table": (interleaved_table, risk_sql(f"SELECT {ALL} FROM risk")),
    "layout_pruned": (layout_pruned, None),
    "schema_report": (
        schema_report,
        GOOD
        + " UNION ALL ".join(
            f"SELECT '{path}' AS path, '{kind}' AS type,"
            f" count(json_extract(raw, '$.{path}')) AS present FROM good"
            for path, kind in _paths(TRADE)
        ),
    ),
}
