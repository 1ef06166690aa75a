"""Session settings and shared staging folders used by the operators."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of text that one Arrow batch may hold, so that a Python worker's memory has a bound.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Sets the bounds of batches, and lets Python workers import this package from where the driver has it (a cluster whose
    machines don't share that path gets it with --py-files)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *paths])
    # A task has the cores that Spark gives it: matrix products inside one don't start threads of their own.
    env["OPENBLAS_NUM_THREADS"] = "1"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Where ``spark.checkpoint.dir`` is unset, a local master (tests) gets a temporary
    folder; a real cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="brindle-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends here, and a lost executor costs a re-read. options: of the writer."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/brindle-stage/{uuid.uuid4().hex}/{name}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it has no more than ``rows``; a larger one is joined as Spark sees fit."""
    return df.hint("broadcast") if df.limit(rows + 1).count() <= rows else df


def shuffle_partitions(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for ``rows`` rows with at most ``per_task`` in each on average, and no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
