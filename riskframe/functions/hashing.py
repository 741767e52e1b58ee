"""Seeded, partition-independent pseudo-randomness from md5.

A row's draw depends only on its key and the seed, never on partitioning or
task order, so results are reproducible under repartition and re-execution
after executor loss, and equal to the SQL oracle's
``('0x' || substr(md5(key || '|' || seed), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _key_text(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.col(p) for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def hash32(*parts, seed: int | str) -> Column:
    """Unsigned 32-bit integer (as BIGINT) from md5(key parts | seed)."""
    text = F.concat(_key_text(*parts), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash60(*parts, seed: int | str) -> Column:
    """Unsigned 60-bit integer (as BIGINT) from the same md5."""
    text = F.concat(_key_text(*parts), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def pick(*parts, seed: int | str, n: Column | int) -> Column:
    """Deterministic draw from ``0 .. n - 1``; reaches every value of any table
    of fewer than 2^60 rows."""
    return hash60(*parts, seed=seed) % (n if isinstance(n, Column) else F.lit(n))


def uniform(*parts, seed: int | str) -> Column:
    """Deterministic draw in [0, 1)."""
    return hash32(*parts, seed=seed) / F.lit(TWO_POW_32)


def sql_hash32(key_sql: str, seed: int | str) -> str:
    """DuckDB text of :func:`hash32` for a single key expression."""
    return f"CAST(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{seed}'), 1, 8)) AS BIGINT)"
