"""Column-name helpers: quoting, presence checks and fresh helper names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """``F.col`` for a literal top-level name, whatever characters it holds."""
    return F.col(quoted(name))


def lookup(available: Iterable[str], name: str) -> str | None:
    """The column Spark would bind ``name`` to, or None.

    An exact match wins; otherwise the match is case-insensitive and must be
    unique.
    """
    available = list(available)
    if name in available:
        return name
    hits = [c for c in available if c.lower() == name.lower()]
    if len(hits) > 1:
        raise AnalysisException(f"Column name {name!r} is ambiguous: {hits}")
    return hits[0] if hits else None


def require_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Resolve every name against ``df`` or raise with all missing ones."""
    available = df.columns
    found = [(name, lookup(available, name)) for name in names]
    missing = [name for name, hit in found if hit is None]
    if missing:
        raise AnalysisException(f"Columns not found: {missing}; available: {available}")
    return [hit for _, hit in found]


def fresh_name(df: DataFrame, stem: str) -> str:
    """A helper column name that no column of ``df`` uses."""
    taken = {c.lower() for c in df.columns}
    name, n = f"__{stem}", 0
    while name.lower() in taken:
        n += 1
        name = f"__{stem}_{n}"
    return name
