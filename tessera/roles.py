"""Column roles and schema-level operators (no data job runs here).

P01 role discovery, P02 drop key, P05/P06 projections, P09 suspicious names,
S05 column guards.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Lower-cased names that mark a column as label-like.
SUSPICIOUS_NAMES = ("split", "y", "target", "label")


@dataclass(frozen=True)
class Roles:
    """Which column is the key, the label and the split flag.

    ``numeric`` / ``categorical`` default to discovery by type (P01); the key,
    label and split columns are never features (Q1, Q2, Q19 of the survey).
    """

    key: str | None = "id"
    label: str | None = "y"
    split: str | None = "split"
    numeric: tuple[str, ...] | None = None
    categorical: tuple[str, ...] | None = None
    extra_exclude: tuple[str, ...] = field(default_factory=tuple)
    discrete: tuple[str, ...] = field(default_factory=tuple)     # numeric columns whose values are classes (M02)

    @property
    def reserved(self) -> set[str]:
        return {c for c in (self.key, self.label, self.split, *self.extra_exclude) if c}

    def numeric_cols(self, df: DataFrame) -> list[str]:
        if self.numeric is not None:
            return [c for c in self.numeric if c in df.columns]
        return [f.name for f in df.schema.fields
                if is_numeric(f.dataType) and f.name not in self.reserved]

    def categorical_cols(self, df: DataFrame) -> list[str]:
        if self.categorical is not None:
            return [c for c in self.categorical if c in df.columns]
        return [f.name for f in df.schema.fields
                if isinstance(f.dataType, T.StringType) and f.name not in self.reserved]

    def feature_cols(self, df: DataFrame) -> list[str]:
        keep = set(self.numeric_cols(df)) | set(self.categorical_cols(df))
        return [c for c in df.columns if c in keep]

    def with_(self, **kw) -> "Roles":
        return replace(self, **kw)


def is_numeric(dt: T.DataType) -> bool:
    """Numeric in the pandas sense: integers, floats, decimals; not booleans."""
    return isinstance(dt, T.NumericType)


def role_table(df: DataFrame, roles: Roles = Roles()) -> list[tuple[str, str]]:
    """(column, role) for every column, in table order."""
    num, cat = set(roles.numeric_cols(df)), set(roles.categorical_cols(df))
    out = []
    for c in df.columns:
        if c == roles.key:
            r = "key"
        elif c == roles.label:
            r = "label"
        elif c == roles.split:
            r = "split"
        elif c in num:
            r = "numeric"
        elif c in cat:
            r = "categorical"
        else:
            r = "other"
        out.append((c, r))
    return out


def require_columns(df: DataFrame, cols, what: str = "table") -> None:
    """Fail fast, before any job, when required columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required column(s): {missing}")


def drop_key(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """P02."""
    return df.drop(roles.key) if roles.key and roles.key in df.columns else df


def project_list(df: DataFrame, keep: list[str], always: tuple[str, ...] = ()) -> DataFrame:
    """Keep the listed columns in *table* order; no match leaves df as is."""
    wanted = set(keep)
    cols = [c for c in df.columns if c in wanted]
    if not cols:
        return df
    extra = [c for c in always if c in df.columns and c not in wanted]
    return df.select(*extra, *cols)


def reorder_kept(df: DataFrame, kept_numeric: list[str], others: list[str],
                 always: tuple[str, ...] = ()) -> DataFrame:
    """Kept numeric columns first, then surviving non-numeric ones."""
    cols = [c for c in kept_numeric if c in df.columns] + \
        [c for c in others if c in df.columns and c not in kept_numeric]
    lead = [c for c in always if c in df.columns and c not in cols]
    return df.select(*lead, *cols)


def suspicious_columns(df: DataFrame) -> list[str]:
    """Columns whose lower-cased, trimmed name is label-like."""
    return [c for c in df.columns if c.strip().lower() in SUSPICIOUS_NAMES]
