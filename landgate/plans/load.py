"""The load: read, count, conform, append, audit, in one pass over the source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.operators import quality as Q
from landgate.operators.conform import conform, nulled_counts, nulled_metrics
from landgate.operators.tables import append_table, create_target, put_batch
from landgate.plans.gate import stage, staged_sides
from landgate.schemas import TRADE, TRADE_TARGET, TargetColumn
from landgate.sources.json_records import read_json
from landgate.sources.landing import batch_identity
from landgate.workspace import workspace


LEDGER = "batch_id string, source string, target string, total bigint, inserted bigint, loaded_at timestamp_ntz"


@dataclass(frozen=True)
class LoadConfig:
    """``ledger`` names a table of finished batches and makes a load repeatable: a batch is the landed files
    as they are (``batch_identity``), or what ``batch`` says; the target is kept by batches, a batch that the
    ledger holds is not loaded again, and one that failed before it was entered there replaces its own rows."""

    source: str
    table: str
    schema: T.StructType = TRADE
    target: Sequence[TargetColumn] = TRADE_TARGET
    multiline: bool = False
    table_path: str | None = None
    enforce_required: bool = True
    audit_table: str | None = None
    invalid_table: str | None = None
    invalid_path: str | None = None
    ledger: str | None = None
    batch: str | None = None


@dataclass(frozen=True)
class LoadReport:
    """``nulled`` counts, per retyped column, values that did not fit and became NULL. ``rejects``
    reads the table of rejects if one was named, else the source again, if and when it is used.
    ``repeated`` tells that the ledger held the batch and nothing was done."""

    source: str
    table: str
    total: int
    valid_count: int
    invalid_count: int
    inserted: int
    nulled: dict[str, int]
    audit: DataFrame = field(repr=False)
    rejects: DataFrame = field(repr=False)
    repeated: bool = False


def run_load(spark: SparkSession, cfg: LoadConfig) -> LoadReport:
    """Append the good records of one landed source to its target table.

    Counting, conforming and appending are one job without a shuffle: the counts are observed on
    the parsed rows while the good ones go on to the files. With ``invalid_table`` the parsed rows
    are staged first, split by validity, so that rejects are kept without a second scan of the
    source. Not idempotent, like any append, unless a ledger is named.
    """
    batch = None
    if cfg.ledger:
        if cfg.invalid_table:
            raise ValueError("rejects of repeatable loads are read from the source, not kept in a table")
        batch = cfg.batch or batch_identity(spark, cfg.source)
        if _finished(spark, cfg, batch):
            return _repeated(spark, cfg)
    parsed = read_json(spark, cfg.source, cfg.schema, cfg.multiline)
    if cfg.invalid_table:
        staged, counts = stage(parsed, workspace(spark, "load"))
        valid, rejects = staged_sides(staged)
        rejected = append_table(rejects.hint("rebalance"), cfg.invalid_table, cfg.invalid_path)
        if rejected != counts["invalid"]:
            raise RuntimeError(f"kept {rejected} of {counts['invalid']} rejected records")
    else:
        observed = Observation()
        valid, _ = Q.split_valid(parsed.observe(observed, *Q.validity_metrics()))
        rejects, counts = Q.split_valid(parsed)[1], None
    nulled = Observation()
    valid = valid.observe(nulled, F.count(F.lit(1)).alias("n"), *nulled_metrics(valid, cfg.target))

    create_target(spark, cfg.table, cfg.target, cfg.table_path, batches=bool(batch))
    rows = conform(valid, cfg.target, cfg.enforce_required)
    inserted = put_batch(rows, cfg.table, batch) if batch else append_table(rows, cfg.table)
    counts = counts or observed.get
    if batch:
        _enter(spark, cfg, batch, counts["total"], inserted)
    changed = nulled_counts(nulled.get, cfg.target)
    audit = load_audit(spark, cfg, counts, inserted, changed)
    if cfg.audit_table:
        append_table(audit, cfg.audit_table)
    return LoadReport(
        source=cfg.source,
        table=cfg.table,
        total=counts["total"],
        valid_count=counts["valid"],
        invalid_count=counts["invalid"],
        inserted=inserted,
        nulled=changed,
        audit=audit,
        rejects=rejects,
    )


def _finished(spark: SparkSession, cfg: LoadConfig, batch: str) -> bool:
    if not spark.catalog.tableExists(cfg.ledger):
        return False
    own = (F.col("batch_id") == batch) & (F.col("target") == cfg.table)
    return not spark.table(cfg.ledger).filter(own).isEmpty()


def _enter(spark: SparkSession, cfg: LoadConfig, batch: str, total: int, inserted: int) -> None:
    row = spark.createDataFrame([(batch, cfg.source, cfg.table, total, inserted, None)], LEDGER)
    append_table(row.withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz")), cfg.ledger)


def _repeated(spark: SparkSession, cfg: LoadConfig) -> LoadReport:
    counts = {"total": 0, "valid": 0, "invalid": 0}
    audit = load_audit(spark, cfg, counts, 0, {})
    if cfg.audit_table:
        append_table(audit, cfg.audit_table)
    nothing = spark.createDataFrame([], cfg.schema)
    return LoadReport(cfg.source, cfg.table, 0, 0, 0, 0, {}, audit, nothing, repeated=True)


def load_audit(
    spark: SparkSession,
    cfg: LoadConfig,
    counts: dict[str, int],
    inserted: int,
    nulled: dict[str, int],
) -> DataFrame:
    figures = (counts["total"], counts["valid"], counts["invalid"], inserted)
    row = spark.createDataFrame(
        [(cfg.source, *figures, cfg.table, list(nulled.items()))],
        "source string, total bigint, valid bigint, invalid bigint, inserted bigint, target string, "
        "nulled array<struct<field: string, nulls: bigint>>",
    )
    return Q.with_shares(row).withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))
