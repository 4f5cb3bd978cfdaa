"""Masks for personal data. All of them keep null as null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratalake.fixed import CPF_HEAD, CPF_TAIL, EMAIL_TAIL, PHONE_HEAD


def cpf(c: Column) -> Column:
    """Digits four to six stay: ``123.456.789-00`` -> ``***.456.***-**``."""
    digits = F.regexp_replace(c, r"\D", "")
    return F.concat(F.lit(CPF_HEAD), F.substring(digits, 4, 3), F.lit(CPF_TAIL))


def email(c: Column) -> Column:
    """The first three characters stay."""
    return F.concat(F.left(c, F.lit(3)), F.lit(EMAIL_TAIL))


def phone(c: Column) -> Column:
    """The last four characters stay (all of a shorter text)."""
    return F.concat(F.lit(PHONE_HEAD), F.right(c, F.lit(4)))


def sha256(c: Column, salt: str | None = None) -> Column:
    text = c.cast("string")
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)
