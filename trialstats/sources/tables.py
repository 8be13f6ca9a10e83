"""Parquet tables of raw readings and results, partitioned by experiment and trial."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trialstats.sources.schemas import primary_key, schema

# The key columns that double as partition directories.
PARTITIONS = ["experiment_id", "trial_id"]


# A table of key slices up to this many rows is sent to all tasks, about 10 MB.
MAX_SLICES = 100_000


def read_table(spark: SparkSession, root: str, table: str, slices: DataFrame | None = None, **keys: str) -> DataFrame:
    """Read ``root/table`` with its declared schema.

    ``keys`` restrict the read to a key slice (``trial_id="t1"``); on partition columns
    the slice prunes directories, on other columns it is pushed down to the files.
    ``slices`` is a table of wanted keys, such as the trials of a report: the directories are
    chosen at run time from what it holds. It is counted first; a table of more than ``MAX_SLICES``
    different keys is joined without being broadcast. A null key selects nothing.
    """
    df = spark.read.schema(schema(table)).parquet(f"{root}/{table}")
    for name, value in keys.items():
        df = df.where(F.col(name) == value)
    if slices is None:
        return df
    wanted = settle(slices.dropna().distinct())
    # The comparison holds for every key; it marks the table as one that selects, which pruning asks for.
    wanted = wanted.where(" AND ".join(f"length({c}) >= 0" for c in wanted.columns))
    return df.join(F.broadcast(wanted) if wanted.count() <= MAX_SLICES else wanted, wanted.columns, "left_semi")


def write_table(df: DataFrame, root: str, table: str, key: Sequence[str] | None = None) -> None:
    """Write results so that a repeated run replaces the rows of the same key and nothing else.

    ``key`` is the primary key of the table, by default the one declared for it. Of the
    experiment / trial directories that occur in ``df``, rows with other keys are carried over;
    other directories stay as they are. Null key parts are values. Rows are spread by
    their keys, which gives few files per directory, and split further inside a directory when
    one of them is large (adaptive execution rebalances).

    The write survives a failure at any point. The new content of all directories concerned is complete
    under ``root/_pending`` before the first of them changes. A run that dies while directories
    are replaced leaves it there, and the next write to the table (or ``finish_write``) replaces
    them again from it before anything else; what died earlier has changed nothing. One writer
    at a time may write to a table.
    """
    spark = df.sparkSession
    by = _directories(table, df.columns)
    names = list(key or primary_key(table, df.columns))
    path = f"{root}/{table}"
    finish_write(spark, root, table, df.schema)
    if not _exists(spark, path):
        _replace(df.hint("rebalance", *[F.col(c) for c in by]), path, by)
        return
    new = settle(df)
    touched = new.selectExpr(f"struct({', '.join(by)}) AS slice").distinct()
    old = spark.read.schema(df.schema).parquet(path).withColumn("slice", F.expr(f"struct({', '.join(by)})"))
    near = old.join(touched, "slice", "left_semi").withColumn("upserted", F.expr(f"struct({', '.join(names)})"))
    written = new.selectExpr(f"struct({', '.join(names)}) AS upserted").distinct()
    merged = new.unionByName(near.join(written, "upserted", "left_anti").select(*df.columns))
    merged.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").partitionBy(*by).parquet(_pending(root, table))
    finish_write(spark, root, table, df.schema)


def finish_write(spark: SparkSession, root: str, table: str, columns: StructType | None = None) -> bool:
    """Bring a write that died to its end: replace the directories that it had prepared.

    Returns whether there was one. Directories that were replaced already are replaced by the
    same rows once more. Preparations that were never complete are removed.
    """
    pending = _pending(root, table)
    complete = _exists(spark, f"{pending}/_SUCCESS")
    if complete:
        rows = spark.read.schema(columns or schema(table)).parquet(pending)
        _replace(rows, f"{root}/{table}", _directories(table, rows.columns))
    files, at = _files(spark, pending)
    files.delete(at, True)
    return complete


def _directories(table: str, columns: Sequence[str]) -> list[str]:
    return [c for c in PARTITIONS if c in columns and not (c == "trial_id" and table.endswith("_ranking"))]


def _pending(root: str, table: str) -> str:
    return f"{root}/_pending/{table}"


def _replace(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the directories that occur in ``rows``."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, whichever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def write_tables(results: dict[str, DataFrame], root: str) -> None:
    """Write several results of one job, one table each.

    Results that share readings share them settled, as the ``*_results`` functions of the jobs
    return them: then the input of the job is evaluated once for all of its tables.
    """
    for table, df in results.items():
        write_table(df, root, table)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary one; a cluster without it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="trialstats-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Store an intermediate table once, so that later steps neither repeat nor re-plan it.

    Meant for trial tables on the way to the experiment level and for what several results of a
    job share. The rows go to the shared folder and survive lost executors.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
