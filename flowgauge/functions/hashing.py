"""Stable hash draws.

`rand(seed)` changes when the input is partitioned differently; an md5 of the
seed and the row key does not, so samples, splits and folds repeat on any
cluster size and need no sort of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPAN = 2**32


def hash_text(seed: int | str, *keys: Column | str) -> Column:
    """32 hex digits drawn from the seed and the row key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_text(k) for k in keys]))


def hash_number(hex_text: Column) -> Column:
    """First 32 bits of a hex digest as a bigint in [0, HASH_SPAN)."""
    return F.conv(F.substring(hex_text, 1, 8), 16, 10).cast("bigint")


def hash_bucket(seed: int | str, buckets: int, *keys: Column | str) -> Column:
    """Bucket number in [0, buckets) of the row key."""
    return F.pmod(hash_number(hash_text(seed, *keys)), F.lit(buckets))


def _text(key: Column | str) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("string")
