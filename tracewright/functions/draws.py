"""Repeatable pseudo-random columns keyed by a row id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WORDS_PER_DIGEST = 4


def uniform(row_id: str, stream: int) -> Column:
    """A double in ``[0, 1)`` fixed by the row id and the stream number.

    Each MD5 digest gives four 32-bit draws. Unlike ``rand()`` the value does
    not depend on the partitioning, so a recomputed task repeats it.
    """
    digest, word = divmod(stream, _WORDS_PER_DIGEST)
    hexed = F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{digest}")).cast("binary"))
    return F.conv(F.substring(hexed, word * 8 + 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
