"""Masking of personal data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from stratalake.functions import masks
from stratalake.functions.names import column, require_columns


def _derived(df: DataFrame, name: str, into: str, expression: Callable[[Column], Column]) -> DataFrame:
    (name,) = require_columns(df, [name])
    return df.withColumn(into, expression(column(name)))


def mask_cpf(df: DataFrame, name: str, into: str | None = None) -> DataFrame:
    return _derived(df, name, into or f"{name}_masked", masks.cpf)


def mask_email(df: DataFrame, name: str, into: str | None = None) -> DataFrame:
    return _derived(df, name, into or f"{name}_masked", masks.email)


def mask_phone(df: DataFrame, name: str, into: str | None = None) -> DataFrame:
    return _derived(df, name, into or f"{name}_masked", masks.phone)


def hash_column(df: DataFrame, name: str, into: str | None = None, salt: str | None = None) -> DataFrame:
    return _derived(df, name, into or f"{name}_hash", lambda c: masks.sha256(c, salt))


def mask_all(
    df: DataFrame,
    cpf: Sequence[str] = (),
    email: Sequence[str] = (),
    phone: Sequence[str] = (),
    hashed: Sequence[str] = (),
    drop_originals: bool = False,
    salt: str | None = None,
) -> DataFrame:
    """All masks in one projection, beside the originals or instead of them."""
    plan = [(cpf, "_masked", masks.cpf), (email, "_masked", masks.email), (phone, "_masked", masks.phone)]
    plan.append((hashed, "_hash", lambda c: masks.sha256(c, salt)))
    used, new = [], {}
    for names, suffix, expression in plan:
        for name in require_columns(df, names):
            used.append(name)
            new[name + suffix] = expression(column(name))
    out = df.withColumns(new) if new else df
    return out.drop(*used) if drop_originals else out
