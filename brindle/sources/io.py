"""Reading and writing: scans with parameters, latest snapshots, guarded sinks, data expectations."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def run_sql(spark: SparkSession, sql: str | Path, params: dict | None = None) -> DataFrame:
    """SQL text, or a file that holds it, with ``:name`` parameters."""
    text = sql.read_text() if isinstance(sql, Path) else sql
    return spark.sql(text, args=params or {})


def scan(spark: SparkSession, table: str, columns: Sequence[str], where: str | None = None, limit: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """A table by configuration: columns, filter, and a limit in a stated order."""
    df = spark.table(table)
    df = df.where(F.expr(where)) if where else df
    df = df.select(*columns)
    return df.orderBy(*(order or columns)).limit(limit) if limit is not None else df


def read_csv_ids(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The id column of a CSV file with a header, or its first column; no nulls, as strings."""
    df = spark.read.csv(path, header=True)
    name = column if column in df.columns else df.columns[0]
    return df.where(df[name].isNotNull()).select(df[name].cast("string").alias(column))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines of a text file, without blank ones."""
    return spark.read.text(path).select(F.trim("value").alias("line")).where("line != ''")


def read_json_list(path: str) -> list:
    return json.loads(Path(path).read_text())


def latest(df: DataFrame, stamp: str) -> DataFrame:
    """The rows of the latest snapshot."""
    top = df.agg(F.max(stamp).alias("_top"))
    return df.join(F.broadcast(top), df[stamp] == F.col("_top")).drop("_top")  # one row


def half_open(ts: str, start: object, end: object) -> Column:
    return (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end))


def require_columns(df: DataFrame, columns: Sequence[str], label: str = "frame") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{label} lacks {missing}")


def write(df: DataFrame, path: str, mode: str = "overwrite", partition: str | None = None, dry_run: bool = False) -> bool:
    """Writes parquet; an empty frame or a dry run writes nothing. With a partition column only its values in df are replaced."""
    if dry_run:
        df.show(20, truncate=False)
        return False
    if df.isEmpty():
        return False
    w = df.write.mode(mode)
    if partition:
        w = w.partitionBy(partition).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return True


def expect(df: DataFrame, key: str, columns: Sequence[str], max_null_rate: float = 0.05) -> None:
    """Raises if a column is missing, the key is null or repeated, or a column has too many nulls. One pass over the data, and one over the keys."""
    require_columns(df, [key, *columns])
    n, no_key, *nulls = df.agg(F.count("*"), F.count_if(F.col(key).isNull()), *[F.count_if(F.col(c).isNull()) for c in df.columns]).first()
    if no_key:
        raise ValueError("null keys")
    if df.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError("duplicate keys")
    bad = {c: k / n for c, k in zip(df.columns, nulls, strict=True) if n and k / n > max_null_rate}
    if bad:
        raise ValueError(f"null rates above {max_null_rate}: {bad}")
