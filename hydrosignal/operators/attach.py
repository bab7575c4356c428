"""Attach a small aggregate to a large table without shuffling the large one by a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrosignal.session import materialize_at, scratch_dir, stored_bytes

#: Rows and stored bytes up to which an aggregate is broadcast: some ten megabytes for rows of a few numbers.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16_000_000
SALTS = 32


def attach(
    facts: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_ROWS,
    salt_by: Sequence[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """``facts`` joined to ``small`` (one row per key) with keys compared null-safe.

    ``small`` is finished and written first, and its rows and bytes are counted. Up to ``limit``
    rows of ``BROADCAST_BYTES`` it is broadcast. Beyond that both sides are dealt by (key, salt): the salt of a fact row comes
    from ``salt_by`` (default: all columns that are not keys), and ``small`` is repeated once
    per salt, so that the rows of a hot key spread over ``salts`` tasks. Column order: the
    columns of ``facts``, then what ``small`` adds. ``how`` is "left" or "inner".
    """
    path = scratch_dir(small.sparkSession, "attached")
    done = materialize_at(small, path)
    fits = stored_bytes(small.sparkSession, path) <= BROADCAST_BYTES and done.limit(limit + 1).count() <= limit
    renamed = done.select(
        *[F.col(c).alias(f"_k_{c}") for c in keys], *[c for c in done.columns if c not in keys]
    )
    match = F.lit(True)
    for c in keys:
        match = match & facts[c].eqNullSafe(F.col(f"_k_{c}"))
    if fits:
        out = facts.join(F.broadcast(renamed), match, how)
    else:
        spread = list(salt_by or [c for c in facts.columns if c not in keys] or keys)
        left = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
        match = F.col("_salt") == F.col("_s")
        for c in keys:
            match = match & left[c].eqNullSafe(F.col(f"_k_{c}"))
        repeated = renamed.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        # without the hint Spark goes by the size of the files, before the rows are repeated, and may broadcast them
        out = left.join(repeated.hint("merge"), match, how).drop("_salt", "_s")
    return out.drop(*[f"_k_{c}" for c in keys])
