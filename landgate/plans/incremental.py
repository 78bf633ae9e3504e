"""Loading what is new of a landing: a ledger of files, compared by an anti-join.

A file is known by path, length and time of change, so one that was written again is new. The files of a run
are taken in batches of bounded size. A batch replaces its own rows of the target, and its files go into the ledger
afterwards: a run that dies in between finds the same files new, forms the same batches and leaves each row once. A file
that can't be read is found by halving its batch; it goes into the ledger as FAILED, and the others are loaded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgate.operators.tables import append_table, create_target, put_batch
from landgate.schemas import target_columns
from landgate.sources.landing import list_landing

LANDED, FAILED = "LANDED", "FAILED"
#: Files of one batch; their paths go to the reader through the driver, as the paths of any scan do.
MAX_FILES = 10_000
FILE = "file_name"
#: What Spark calls an error while a file is read.
UNREADABLE = "FAILED_READ_FILE"
LEDGER = "path string, length bigint, modified timestamp, rows bigint, batch_id string, status string, cause string"


@dataclass(frozen=True)
class NewFiles:
    landed: int
    failed: int
    rows: int
    batches: tuple[str, ...]


def new_files(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """(path, length, modified) of the landed files that the ledger does not hold as they are now. Files of
    no bytes are not listed, by Spark either; they are new once something is in them."""
    listed = list_landing(spark, path)
    if not spark.catalog.tableExists(ledger):
        return listed
    return listed.join(spark.table(ledger), ["path", "length", "modified"], "left_anti")


def _plain_path(uri: Column) -> Column:
    """The path of a listing from the address that a reader gives its rows."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def _literal(path: str) -> str:
    """A path in which nothing is a pattern."""
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in path)


def _mark(files: list) -> str:
    names = sorted(f"{f.path}\n{f.length}\n{f.modified.isoformat()}" for f in files)
    return hashlib.sha256("\n".join(names).encode()).hexdigest()[:32]


def load_new(
    spark: SparkSession,
    path: str,
    table: str,
    ledger: str,
    read: Callable[[list[str]], DataFrame],
    table_path: str | None = None,
    ledger_path: str | None = None,
    max_files: int = MAX_FILES,
) -> NewFiles:
    """Load the landed files that are not in the ledger yet; ``read`` makes rows of some paths.

    ``read`` returns rows straight from its scan, to which ``file_name`` is added. The target is
    declared on first use, partitioned by batch. The ledger gets one row per file with its rows, also for files that
    give none, and with LANDED or FAILED and the cause. Files are taken in the order of their change, then of their
    path. A file that failed is tried again when it changed. Two runs at the same time are not kept apart.
    """
    landed = failed = rows = 0
    batches = []
    while True:
        files = new_files(spark, path, ledger).orderBy("modified", "path").limit(max_files).collect()
        if not files:
            return NewFiles(landed, failed, rows, tuple(batches))
        open_batches = [files]
        while open_batches:
            batch = open_batches.pop()
            mark = _mark(batch)
            try:
                counts = _put(spark, table, table_path, mark, read([_literal(f.path) for f in batch]))
                entries, status, cause = counts, LANDED, None
            except (PySparkException, Py4JJavaError) as error:
                if UNREADABLE not in str(error):
                    raise  # a full disk or a wrong expression is no fault of a file
                if len(batch) > 1:
                    half = len(batch) // 2
                    open_batches += [batch[half:], batch[:half]]
                    continue
                entries, status, cause = None, FAILED, _cause(error)
            _enter(spark, ledger, ledger_path, batch, mark, entries, status, cause)
            if status == FAILED:
                failed += 1
            else:
                landed += len(batch)
                rows += spark.table(table).filter(F.col("batch_id") == mark).count()
                batches.append(mark)


def _cause(error: Exception) -> str:
    """The line that names the file, and what its reader said."""
    lines = str(error).splitlines()
    at = next(i for i, line in enumerate(lines) if UNREADABLE in line)
    why = next((line for line in lines[at:] if line.startswith("Caused by:")), "")
    return f"{lines[at].strip()} {why}"[:1000]


def _put(spark: SparkSession, table: str, table_path: str | None, mark: str, df: DataFrame) -> DataFrame:
    named = df.withColumn(FILE, _plain_path(F.col("_metadata.file_path")))
    create_target(spark, table, target_columns(named.schema), table_path, batches=True)
    put_batch(named, table, mark)
    return spark.table(table).filter(F.col("batch_id") == mark).groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"))


def _enter(spark, ledger, ledger_path, batch, mark, counts, status, cause) -> None:
    files = spark.createDataFrame([(f.path, f.length, f.modified) for f in batch], "path string, length bigint, modified timestamp")
    if counts is None:
        files = files.withColumn("rows", F.lit(0).cast("bigint"))
    else:
        plain = files.withColumn(FILE, F.regexp_replace("path", "^file:/+", "file:/"))
        files = plain.join(counts, FILE, "left").select("path", "length", "modified", F.coalesce("rows", F.lit(0)).alias("rows"))
    entered = files.select(
        "*", F.lit(mark).alias("batch_id"), F.lit(status).alias("status"), F.lit(cause).cast("string").alias("cause")
    )
    append_table(entered, ledger, ledger_path)
