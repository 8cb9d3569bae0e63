"""Projection and schema operators (strict / tolerant drop, ordered select,
pattern drop, column coverage of two tables)."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Back-tick quote a flat column name (names may contain dots)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def drop_strict(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns; a name that is not present is an error (``KeyError``)."""
    cols = list(cols)
    missing = [c for c in dict.fromkeys(cols) if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*[col(c) for c in dict.fromkeys(cols)])


def drop_tolerant(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the named columns that exist; absent names are ignored."""
    present = [c for c in dict.fromkeys(cols) if c in df.columns]
    return df.drop(*[col(c) for c in present]) if present else df


def drop_matching(df: DataFrame, suffixes: Iterable[str] = (),
                  contains: Iterable[str] = (), patterns: Iterable[str] = ()) -> DataFrame:
    """Drop every column whose name ends with a suffix, contains a substring
    or matches a shell pattern (the commented-out feature-group switches)."""
    suffixes, contains, patterns = list(suffixes), list(contains), list(patterns)
    doomed = [c for c in df.columns
              if any(c.endswith(s) for s in suffixes)
              or any(s in c for s in contains)
              or any(fnmatch.fnmatchcase(c, p) for p in patterns)]
    return drop_tolerant(df, doomed)


def drop_group(df: DataFrame, groups: dict[str, list[str]], names: Iterable[str]) -> DataFrame:
    """Tolerant drop of named column groups (ablation switches)."""
    cols = [c for g in names for c in groups[g]]
    return drop_tolerant(df, cols)


def select_ordered(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Select columns in the given order; a missing one is an error."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[col(c) for c in cols])


def column_coverage(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per column name: present on each side and its non-null count there.

    One aggregate pass per table (``count(col)`` for every column), then the
    two single-row results are unpivoted and full-outer joined on the name.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        counts = df.agg(*[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
        pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                                   F.col(f"c{i}").alias(f"non_null_{tag}"))
                          for i, c in enumerate(df.columns)])
        return counts.select(F.inline(pairs))

    l, r = side(left, "left"), side(right, "right")
    return (l.join(r, "column", "full")
            .select("column",
                    F.col("non_null_left").isNotNull().alias("in_left"),
                    F.col("non_null_right").isNotNull().alias("in_right"),
                    "non_null_left", "non_null_right"))
