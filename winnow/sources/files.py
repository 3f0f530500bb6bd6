"""Delimited, JSON and parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.functions.scalar import nan_to_null, null_literal

# Declared type names and the Spark types they stand for.
DECLARED_TYPES = {
    "str": "string",
    "category": "string",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float32": "float",
    "float64": "double",
    "datetime": "timestamp_ntz",
}
INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def header_of(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """Separator and column names: ``;``, or ``,`` when that leaves a single column."""
    line = spark.read.text(path).first()[0].lstrip("﻿").rstrip("\r")
    sep = ";" if ";" in line else ","
    return sep, [name.strip().strip('"') for name in line.split(sep)]


def declared_cast(value: Column, declared: str) -> Column:
    """Cast text to a declared type; what does not parse becomes NULL."""
    spark_type = DECLARED_TYPES.get(declared, declared)
    if spark_type == "string":
        return value
    if spark_type == "timestamp_ntz":
        return F.try_to_timestamp(value).cast("timestamp_ntz")
    number = value.try_cast("double")
    if spark_type in INTEGERS:
        return F.coalesce(value.try_cast(spark_type), number.try_cast(spark_type))
    return nan_to_null(number).cast(spark_type)


def apply_type_map(df: DataFrame, types: Mapping[str, str], dates: tuple[str, ...] = ()) -> DataFrame:
    """One ``select``: literal ``NULL`` cells to NULL, then the declared casts."""
    out = []
    for f in df.schema:
        cell = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            cell = null_literal(cell)
            if f.name in dates:
                cell = declared_cast(cell, "datetime")
            elif f.name in types:
                cell = declared_cast(cell, types[f.name])
        elif f.name in types:
            cell = cell.try_cast(DECLARED_TYPES.get(types[f.name], types[f.name]))
        out.append(cell.alias(f.name))
    return df.select(*out)


def read_datamart(
    spark: SparkSession, path: str, types: Mapping[str, str] | None = None, dates: tuple[str, ...] = (),
    infer_numbers: bool = True,
) -> DataFrame:
    """A wide delimited file with a partial type map.

    Columns outside the map become doubles where every filled cell is a number (one scan decides for all), else text.
    """
    sep, names = header_of(spark, path)
    raw = (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .option("sep", sep).option("header", True).option("enforceSchema", True).option("nullValue", "NULL").csv(path)
    )
    types = dict(types or {})
    open_columns = [n for n in names if n not in types and n not in dates]
    if infer_numbers and open_columns:
        cells = [(F.col(f"`{n}`"), F.col(f"`{n}`").try_cast("double")) for n in open_columns]
        row = raw.agg(*[
            ((F.count(text) > 0) & (F.count(text) == F.count(number))).alias(f"c{i}") for i, (text, number) in enumerate(cells)
        ]).first()
        types |= {n: "double" for i, n in enumerate(open_columns) if row[f"c{i}"]}
    return apply_type_map(raw, types, tuple(d for d in dates if d in names))


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False) -> DataFrame:
    """JSON lines, or with ``multiline`` one JSON list or object per file."""
    return spark.read.schema(schema).json(path, multiLine=multiline)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, *sets: str, split: str = "split") -> DataFrame:
    """Stored split; naming sets prunes the partitions of the others."""
    df = spark.read.parquet(path)
    return df.filter(F.col(split).isin(*sets)) if sets else df


def read_or_split(
    spark: SparkSession, stored: str, raw: Callable[[], DataFrame], split_with: Callable[[DataFrame], DataFrame], *sets: str, split: str = "split"
) -> DataFrame:
    """The stored split; where there is none the raw data is read and split."""
    try:
        return read_split(spark, stored, *sets, split=split)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    df = split_with(raw())
    return df.filter(F.col(split).isin(*sets)) if sets else df


def write_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path + "/csv")
    df.write.mode("overwrite").json(path + "/json")


def split_metadata(df: DataFrame, cutoffs: Mapping[str, str], split: str = "split") -> dict:
    """Cutoffs, row counts per set and the column list."""
    rows = {r[split]: r["count"] for r in df.groupBy(split).count().collect()}
    return {"cutoffs": dict(cutoffs), "rows": rows, "columns": [c for c in df.columns if c != split]}


def write_tables(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """One folder per result table."""
    for name, table in tables.items():
        table.write.mode("overwrite").format(fmt).save(f"{path}/{name}")


def cache_parquet(df: DataFrame, path: str) -> DataFrame:
    """Store a typed table once; later reads are columnar with pushdown."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
