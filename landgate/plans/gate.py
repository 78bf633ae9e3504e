"""The quality gate: read, split, count, profile, check, judge, publish, audit."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.operators import quality as Q
from landgate.operators.causes import cause_entries, cause_metrics, cause_number
from landgate.operators.tables import append_table, overwrite_table, publish_files
from landgate.schemas import BILLING, BILLING_KEY_FIELDS, CORRUPT
from landgate.sources.json_records import read_json
from landgate.workspace import workspace

STAGED_FLAG = "is_valid"
CAUSE = "_cause"


@dataclass(frozen=True)
class GateConfig:
    """``table_root``, a folder that outlives the run, makes the gate write good records once:
    they are staged there and the tables show those files. Existing tables are switched over if they
    have the same columns and are not managed; others are refused unless ``replace_tables`` is set.
    Without ``table_root`` the records are staged in the session's shared folder and copied into managed
    tables."""

    source: str
    schema: T.StructType = BILLING
    key_fields: Sequence[str] = BILLING_KEY_FIELDS
    rules: Sequence[Q.Rule] = Q.BILLING_RULES
    multiline: bool = True
    granularity: str = "element"
    valid_table: str | None = None
    invalid_table: str | None = None
    audit_table: str | None = None
    table_root: str | None = None
    replace_tables: bool = False


@dataclass(frozen=True)
class GateReport:
    """``summary`` has one row: counts, shares, verdict and, nested, null profile and violations.
    ``causes`` says how many records each cause rejected."""

    source: str
    total: int
    valid_count: int
    invalid_count: int
    status: str
    valid: DataFrame = field(repr=False)
    invalid: DataFrame = field(repr=False)
    summary: DataFrame = field(repr=False)
    null_stats: DataFrame = field(repr=False)
    violations: DataFrame = field(repr=False)
    causes: DataFrame = field(repr=False)
    tables: dict = field(default_factory=dict)


@contextmanager
def _open_files(spark: SparkSession, n: int):
    """Let a writing task hold ``n`` files open, so that it need not sort its rows by their file."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stage(
    parsed: DataFrame,
    path: str,
    key_fields: Sequence[str] = (),
    rules: Sequence[Q.Rule] = (),
    corrupt: str = CORRUPT,
    causes: T.StructType | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Write parsed records once, split by validity, and take all gate metrics on the way.

    This is the only job that reads the source. The metrics come from the tasks that write, with no
    shuffle above them, so a task run again after a lost executor is counted once. With ``causes``,
    the declared schema, the causes of rejects are counted, too.
    """
    observed = Observation()
    flagged = parsed.withColumn(STAGED_FLAG, Q.is_valid(corrupt))
    if causes is not None:
        flagged = flagged.withColumn(CAUSE, cause_number(causes, corrupt))
    flagged = flagged.observe(
        observed,
        *Q.validity_metrics(corrupt),
        *Q.quality_metrics(key_fields, rules, among=F.col(STAGED_FLAG)),
        *(cause_metrics(causes, CAUSE) if causes is not None else ()),
    ).drop(CAUSE)
    with _open_files(parsed.sparkSession, 2):
        flagged.write.mode("errorifexists").partitionBy(STAGED_FLAG).parquet(path)
    # Declared, not inferred: partition values would come back as text, and an empty source leaves
    # nothing to infer from.
    schema = T.StructType([*parsed.schema.fields, T.StructField(STAGED_FLAG, T.BooleanType())])
    return parsed.sparkSession.read.schema(schema).parquet(path), observed.get


def staged_sides(staged: DataFrame, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Good and rejected records of a staged split; each reads only its own files."""
    flag = F.col(STAGED_FLAG)
    return (
        staged.filter(flag).drop(STAGED_FLAG, corrupt),
        staged.filter(~flag).drop(STAGED_FLAG),
    )


def summarize(
    spark: SparkSession,
    metrics: dict[str, int],
    source: str,
    key_fields: Sequence[str],
    rules: Sequence[Q.Rule],
) -> DataFrame:
    """Counts, shares, null profile, violations and verdict as one row, from the gate's metrics."""
    names = list(metrics)
    row = spark.createDataFrame([tuple(metrics.values())], ", ".join(f"{n} bigint" for n in names))
    judged = row.select(
        F.lit(source).alias("source"),
        "total",
        "valid",
        "invalid",
        Q.null_entries(key_fields).alias("null_stats"),
        Q.violation_entries(rules).alias("violations"),
    )
    return Q.with_shares(judged).withColumn(
        "status", Q.verdict(F.col("invalid"), F.size("violations"))
    )


def run_gate(spark: SparkSession, cfg: GateConfig) -> GateReport:
    """Run the whole gate over one landed source, reading it once."""
    parsed = read_json(spark, cfg.source, cfg.schema, cfg.multiline, cfg.granularity)
    return gate_records(parsed, cfg)


def gate_records(parsed: DataFrame, cfg: GateConfig) -> GateReport:
    """The gate over records that are parsed already.

    Tables are written only for a side that has records; a failed write raises.
    """
    spark = parsed.sparkSession
    path = workspace(spark, "gate", root=cfg.table_root)
    staged, metrics = stage(parsed, path, cfg.key_fields, cfg.rules, causes=cfg.schema)
    causes = cause_entries(cfg.schema, metrics)
    valid, invalid = staged_sides(staged)
    summary = summarize(spark, metrics, cfg.source, cfg.key_fields, cfg.rules)

    tables = {}
    if cfg.valid_table and metrics["valid"]:
        if cfg.table_root:
            where = f"{path}/{STAGED_FLAG}=true"
            publish_files(spark, cfg.valid_table, valid.schema, where, cfg.replace_tables)
            tables[cfg.valid_table] = metrics["valid"]
        else:
            tables[cfg.valid_table] = _verified(overwrite_table(valid, cfg.valid_table))
    if cfg.invalid_table and metrics["invalid"]:
        # Every reading task leaves a small file of rejects; bring them to a sensible file size.
        compact = invalid.hint("rebalance")
        if cfg.table_root:
            where = f"{path}-rejects"
            compact.write.parquet(where)
            publish_files(spark, cfg.invalid_table, invalid.schema, where, cfg.replace_tables)
            found = spark.table(cfg.invalid_table).count()
            tables[cfg.invalid_table] = _verified((metrics["invalid"], found))
        else:
            tables[cfg.invalid_table] = _verified(overwrite_table(compact, cfg.invalid_table))

    if cfg.audit_table:
        append_table(gate_audit(summary, cfg), cfg.audit_table)
    head = summary.first()
    return GateReport(
        source=cfg.source,
        total=head["total"],
        valid_count=head["valid"],
        invalid_count=head["invalid"],
        status=head["status"],
        valid=valid,
        invalid=invalid,
        summary=summary,
        null_stats=summary.select(F.inline("null_stats")),
        violations=summary.select(F.inline("violations")),
        causes=spark.createDataFrame(causes, "cause string, path string, records bigint"),
        tables=tables,
    )


def _verified(counts: tuple[int, int]) -> int:
    written, found = counts
    if written != found:
        raise RuntimeError(f"wrote {written} rows but the table holds {found}")
    return found


def gate_audit(summary: DataFrame, cfg: GateConfig) -> DataFrame:
    """The run as one row of an audit table."""
    return summary.withColumns(
        {
            "target": F.lit(cfg.valid_table).cast("string"),
            "validated_at": F.current_timestamp().cast("timestamp_ntz"),
        }
    )
