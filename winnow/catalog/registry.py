"""Registry of queries and their SQL; shared SQL views and result conventions."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.operators.splits import time_group_split
from winnow.session import tune
from winnow.sources.tables import leads

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TRAIN_CUTOFF, VAL_CUTOFF = "1995-09-30", "1996-03-31"

VIEWS = f"""WITH li AS (
  SELECT l_orderkey, count(*) AS line_cnt, sum(l_quantity) AS qty_sum, avg(l_discount) AS disc_avg
  FROM lineitem GROUP BY l_orderkey),
leads AS (
  SELECT o_orderkey AS lead_id, o_custkey AS account_id, o_orderdate AS created_at, o_orderpriority AS source,
    c_mktsegment AS channel, n_name AS record_type, o_totalprice AS total_price, c_acctbal AS acctbal,
    line_cnt, qty_sum, disc_avg, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target,
    CAST((o_orderkey * 7919) % 700 + CASE WHEN o_orderstatus = 'F' THEN 300 ELSE 0 END AS DOUBLE)
      / CAST(1000 AS DOUBLE) AS score
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN li ON l_orderkey = o_orderkey),
gsplit AS (
  SELECT account_id, CASE WHEN min(created_at) <= TIMESTAMP '{TRAIN_CUTOFF}' THEN 'train'
    WHEN min(created_at) <= TIMESTAMP '{VAL_CUTOFF}' THEN 'validation' ELSE 'test' END AS split
  FROM leads GROUP BY account_id),
splits AS (SELECT leads.*, split FROM leads JOIN gsplit USING (account_id)),
train AS (SELECT * FROM splits WHERE split = 'train'),
"""


def view_sql(body: str) -> str:
    """The shared views, then ``body`` (which may start with further views)."""
    body = body.strip()
    return VIEWS + body if body[:6].upper() != "SELECT" else VIEWS.rstrip().rstrip(",") + "\n" + body


def union_sql(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def normal(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Integers and flags as BIGINT, doubles rounded, dates as text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
            c = c.cast("int").cast("bigint") if isinstance(f.dataType, T.BooleanType) else c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), special.get(f.name, digits))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, digits: int = 6, **special: int):
    """Register ``fn(spark, path)``; ``sql`` is a full statement or one over the shared views."""

    def keep(fn):
        def run(spark: SparkSession, path: str) -> DataFrame:
            return normal(fn(tune(spark), path), digits, **special)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def lead_query(name: str, body: str, digits: int = 6, **special: int):
    return query(name, view_sql(body), digits, **special)


@contextmanager
def cut_small(spark: SparkSession, rows: int = 700):
    """Every global order is cut into buckets, as on data that no task holds."""
    spark.conf.set("spark.winnow.taskRows", str(rows))
    try:
        yield
    finally:
        spark.conf.unset("spark.winnow.taskRows")


def split_leads(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Leads with their ``split``, only the wanted columns joined in."""
    need = [*columns, *[c for c in ("account_id", "created_at") if c not in columns]]
    return time_group_split(leads(spark, path, *need), "created_at", "account_id", TRAIN_CUTOFF, VAL_CUTOFF)


def train_of(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "train")
