"""Writing tables: declare, append, replace, publish, lay out, and keep an audit trail."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgate.schemas import TargetColumn


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


#: The partition column of a table whose batches can be loaded again.
BATCH = "batch_id"


def create_target(
    spark: SparkSession,
    name: str,
    target: Sequence[TargetColumn],
    path: str | None = None,
    batches: bool = False,
) -> None:
    """Declare a parquet table if it is not there yet; load stamps default to the current time. With
    ``batches`` it has a last column ``batch_id``, by which it is partitioned."""
    columns = ", ".join(
        f"`{c.name}` {c.type}"
        + (" NOT NULL" if c.required else "")
        + (" DEFAULT current_timestamp()" if c.is_stamp else "")
        for c in target
    )
    where = " LOCATION '{}'".format(path.replace("'", "\\'")) if path else ""
    split = f" PARTITIONED BY ({BATCH})" if batches else ""
    columns += f", {BATCH} string" if batches else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet{split}{where}")


def _save(df: DataFrame, name: str, mode: str, path: str | None) -> int:
    # The count is taken on the last operator before the files are written, that is in the tasks
    # that write: a task that is lost and run again is counted once, concurrent writers to the
    # table are not counted at all, and nothing is read back.
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("n")).write.format("parquet").mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return written.get["n"]


def append_table(df: DataFrame, name: str, path: str | None = None) -> int:
    """Append by column name, creating the table if needed; returns the rows inserted.

    Not idempotent: appending twice adds twice.
    """
    return _save(df, name, "append", path)


def put_batch(df: DataFrame, name: str, batch: str) -> int:
    """Make ``df`` the rows of one batch of a table declared with ``batches``; returns their number.

    Whatever the batch held before is replaced, so putting it again, also after a failure half-way, leaves it
    once. Other batches are not touched.
    """
    spark = df.sparkSession
    if spark.table(name).columns[-1:] != [BATCH]:
        raise ValueError(f"table {name} is not kept by batches")
    written, view = Observation(), f"batch_{uuid.uuid4().hex}"
    df.observe(written, F.count(F.lit(1)).alias("n")).createOrReplaceTempView(view)
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns[:-1])
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {_quoted(name)} PARTITION ({BATCH} = '{batch}') SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    return written.get["n"]


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> tuple[int, int]:
    """Replace the table; returns rows written and rows then counted in the table.

    The rows are written first, with ``path`` to a new folder below it and without to a new managed table,
    and only then the name is switched over: a failed write leaves the old contents, and ``df`` may read the
    table that it replaces. Between dropping a managed table and giving its name to the new one lies no more
    than a catalog operation; the new rows are then in a table named ``<name>_<8 digits>``.
    """
    spark = df.sparkSession
    if path is None:
        new = _beside(name)
        try:
            written = _save(df, new, "errorifexists", None)
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(new)}")
            raise
        _rename(spark, new, name)
    else:
        where, seen = f"{path.rstrip('/')}/{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(where)
        written = seen.get["n"]
        publish_files(spark, name, df.schema, where, replace=True)
    return written, df.sparkSession.table(name).count()


def _beside(name: str) -> str:
    *before, last = name.split(".")
    return ".".join([*before, f"{last}_{uuid.uuid4().hex[:8]}"])


def _rename(spark: SparkSession, new: str, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(f"ALTER TABLE {_quoted(new)} RENAME TO {_quoted(name)}")


def _is_managed(spark: SparkSession, name: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").filter("col_name = 'Type'")
    return any(r.data_type == "MANAGED" for r in rows.collect())


def publish_files(
    spark: SparkSession, name: str, schema, path: str, replace: bool = False
) -> None:
    """Let table ``name`` show the parquet files already written under ``path``.

    An external table with the same columns is switched to the new files in one catalog operation,
    so readers see the old or the new contents and a failed run changes nothing. A managed table,
    whose files would go with it, and one with other columns are refused; with ``replace`` the new
    table stands under another name before the old one is dropped.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = path.replace("'", "\\'")
    create = f"CREATE TABLE {{}} ({columns}) USING parquet LOCATION '{where}'"
    if not spark.catalog.tableExists(name):
        spark.sql(create.format(_quoted(name)))
        return
    same = [(f.name, f.dataType) for f in spark.table(name).schema.fields] == [
        (f.name, f.dataType) for f in schema.fields
    ]
    if same and not _is_managed(spark, name):
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{where}'")
        spark.catalog.refreshTable(name)
        return
    if not replace:
        raise ValueError(f"table {name} is managed or has other columns; say so to replace it")
    new = _beside(name)
    spark.sql(create.format(_quoted(new)))
    _rename(spark, new, name)


def clustered(
    df: DataFrame,
    by: Sequence[str],
    spread: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Range-partition and sort by ``by``, so that files cover narrow value ranges when written.

    Rows equal in all of ``by`` would land in one task, and open versions share most of those
    values. ``spread`` names further columns that tell such rows apart; as trailing range keys they
    cut a group, even one holding most of the table, into many ranges. Columns that lookups ask
    for, the identifier first, serve best; if none are named, all further plain columns serve. The
    input runs twice, once to sample the ranges.
    """
    if spread is None:
        plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
        variants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.VariantType)]
        spread = [c for c in plain if c not in by and c not in variants]
    keys = [*by, *spread]
    count = () if partitions is None else (partitions,)
    return df.repartitionByRange(*count, *keys).sortWithinPartitions(*keys)
