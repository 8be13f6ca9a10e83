"""What the training-data operators share: the shared folder, text keys and Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the words of a text, as given by the contracts. ``bytes.split()`` splits at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows in an Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = "1000"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table, with Arrow batches bounded for the Python stages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str | Column) -> Column:
    """Sixteen bytes that stand for a text: equal texts share them."""
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(column))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A local session without the setting gets one of its own; a cluster without it is an error.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: it survives lost executors and is computed once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


Batches = Iterator[pa.RecordBatch]


def by_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Batches], Batches]:
    """A ``mapInArrow`` function from a function of one batch; batches without rows are passed over."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out

    return run


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()
