"""Row and multiset digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from stratalake.fixed import HASH_SEPARATOR

LANES = 13
LANE = 2**20 - 1


def row_digest(cols: Sequence[Column], null_token: str | None = None) -> Column:
    """SHA-256 over the joined column texts.

    By default nulls are skipped, so ``(a, null, b)`` equals ``(a, b, null)``.
    With a ``null_token`` they take part, and the separator inside values is
    escaped, so different rows never join to the same text.
    """
    texts = [c.cast("string") for c in cols]
    if null_token is not None:
        escaped = [
            F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit(HASH_SEPARATOR), F.lit("\\" + HASH_SEPARATOR))
            for t in texts
        ]
        texts = [F.coalesce(t, F.lit("\\" + null_token)) for t in escaped]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256)


def lane_sums(digest: Column) -> list[Column]:
    """Sums of the 256 bits of the digest, taken as thirteen short numbers.

    Four words of sixty bits give three twenty-bit numbers each, the last
    sixteen bits give one. Sums commute, so they combine map-side and do not
    depend on row order or partitioning; a 64-bit sum has room for 2**43 rows.
    """
    lanes = []
    for i in range(4):
        word = F.conv(F.substring(digest, 15 * i + 1, 15), 16, 10).cast("bigint")
        lanes += [word.bitwiseAND(F.lit(LANE)), F.shiftright(word, 20).bitwiseAND(F.lit(LANE)), F.shiftright(word, 40)]
    lanes.append(F.conv(F.substring(digest, 61, 4), 16, 10).cast("bigint"))
    return [F.sum(lane) for lane in lanes]
