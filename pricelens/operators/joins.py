"""Join helper: a salted join for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens import constants as C


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                buckets: int = C.DEFAULT_SALT_BUCKETS, salt_from: str | None = None) -> DataFrame:
    """Equi-join that spreads every key of `big` over `buckets` tasks.

    Each `big` row gets a salt (hash of `salt_from`, or of the whole row);
    `small` is replicated once per salt value. Use when one key may hold a large share of `big` and `small`
    cannot be broadcast.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError("salted_join keeps `big` on the left; got how=" + how)
    # Deterministic salt, so a re-run task after an executor loss sends every
    # row to the same bucket again.
    src = [F.col(salt_from)] if salt_from else [F.col(c) for c in big.columns]
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*src), F.lit(buckets)))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<bigint>")))
    return b.join(s, on=[*on, "_salt"], how=how).drop("_salt")
