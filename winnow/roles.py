"""Column roles: which columns are target, keys, numeric or categorical."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Columns that never enter an analysis or a model.
LEAKAGE_COLUMNS = ("LeadId", "account_Id", "Id", "Opportunityid", "Contactid", "AccountId")
# Columns the test battery leaves out besides.
TEST_EXCLUDED = (*LEAKAGE_COLUMNS, "SystemModstamp", "Branch_Name__c", "BranchName")
# Name fragments that mark a numeric column as a key or a date part.
NON_MEASURE_FRAGMENTS = ("id", "Id", "ID", "date", "Date", "time", "Time", "year", "month", "day")
# Name fragments that mark a date column.
DATE_FRAGMENTS = ("date", "time", "tarih")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.IntegralType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if is_numeric(f.dataType) and f.name not in skip]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def measure_columns(df: DataFrame) -> list[str]:
    """Numeric columns whose name does not look like a key or a date part."""
    return [c for c in numeric_columns(df) if not any(x in c for x in NON_MEASURE_FRAGMENTS)]


def detect_date_column(columns: Sequence[str]) -> str | None:
    """First column named like a date, leaving derived year-months and relative dates out."""
    for name in columns:
        low = name.lower()
        if any(x in low for x in DATE_FRAGMENTS) and not name.endswith("_YearMonth") and "relative" not in low:
            return name
    return None


def exclude_columns(
    df: DataFrame, drop: Iterable[str] = LEAKAGE_COLUMNS, drop_dates: bool = True
) -> DataFrame:
    """Drop ids, leakage columns and (optionally) everything named like a date."""
    gone = [c for c in df.columns if c in set(drop) or (drop_dates and "date" in c.lower())]
    return df.drop(*gone)


def rename_clean(df: DataFrame) -> DataFrame:
    """Columns with names of letters, digits and underscores only; names that meet get a number."""
    taken: set[str] = set()
    names = []
    for c in df.columns:
        base = re.sub(r"\W+", "_", c).strip("_") or "column"
        name, k = base, 1
        while name.lower() in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name.lower())
        names.append(name)
    return df.toDF(*names)


@dataclass(frozen=True)
class ColumnRoles:
    target: str | None = None
    group: str | None = None
    time: str | None = None
    source: str | None = None
    ids: tuple[str, ...] = ()
    numeric: tuple[str, ...] = field(default=())
    categorical: tuple[str, ...] = field(default=())

    @property
    def reserved(self) -> tuple[str, ...]:
        """Columns no learned cleaning or selection step may touch."""
        return tuple(c for c in (self.target, self.group, self.time, *self.ids) if c)

    @classmethod
    def infer(
        cls,
        df: DataFrame,
        target: str | None = None,
        group: str | None = None,
        time: str | None = None,
        source: str | None = None,
        ids: Sequence[str] = (),
    ) -> "ColumnRoles":
        """From the schema alone; runs no job."""
        reserved = [c for c in (target, group, time, *ids) if c]
        return cls(
            target,
            group,
            time or detect_date_column(df.columns),
            source,
            tuple(ids),
            tuple(numeric_columns(df, reserved)),
            tuple(categorical_columns(df, reserved)),
        )


def project_roles(df: DataFrame, roles: ColumnRoles, *kinds: str) -> DataFrame:
    """Keep the ids, the target and the columns of the named roles."""
    keep = [*roles.ids, *([roles.target] if roles.target else [])]
    for kind in kinds:
        keep += [c for c in getattr(roles, kind) if c not in keep]
    return df.select(*keep)
