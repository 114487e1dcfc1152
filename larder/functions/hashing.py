"""Deterministic, engine-independent hashing of row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Key hashes lie in ``[0, HASH_SPAN)``.
HASH_SPAN = 1 << 60


def key_hash(*keys: Column | str, seed: int = 42) -> Column:
    """Hash of 60 bits, of the seed and the keys joined by ``|``.

    A null key part is hashed as an empty string.  The value depends only on
    the key, so a sample is the same after a retry, a repartition or a rerun.
    """
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    text = F.concat(F.lit(f"{seed}:"), F.concat_ws("|", *parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def key_bucket(*keys: Column | str, buckets: int, seed: int = 42) -> Column:
    """``key_hash`` folded into ``[0, buckets)``."""
    return F.pmod(key_hash(*keys, seed=seed), F.lit(buckets).cast("bigint"))
