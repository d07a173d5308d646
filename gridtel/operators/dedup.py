"""Keyed deduplication that stays fast when one key is hot.

``first``/``latest`` are expressed as ``min``/``max`` of a struct whose
leading fields are the ordering columns.  That is an ordinary aggregate, so
Spark combines map-side before the shuffle: a key holding a third of all
rows is reduced to one row per task before it travels, instead of being
buffered whole in one window partition.

Rows are grouped by a 64-bit hash of the key and then by the key itself, which makes the same groups: Spark sorts rows
by the first eight bytes of the first key, and ids share theirs, so that most comparisons would read whole keys.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Reserved name of the key's hash.
KEY_HASH = "__key_hash"


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool, hashed: str | None = None) -> DataFrame:
    keys = list(keys)
    out_columns = [c for c in df.columns if c != hashed]
    order = [c for c in order if c not in keys]
    rest = [c for c in out_columns if c not in keys and c not in order]
    # A flag before each ordering column puts NULLs last: a row
    # with a missing ordering value never wins "first" or "latest".  ``max`` needs
    # no flag, as NULL is the smallest value, nor does a column that cannot be NULL.
    nullable = set() if latest else {f.name for f in df.schema.fields if f.nullable}
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c)] if c in nullable else [F.col(c)]
    packed = F.struct(*fields, *[F.col(c) for c in rest])
    agg = F.max(packed) if latest else F.min(packed)
    out = df.groupBy(F.col(hashed) if hashed else F.xxhash64(*keys).alias(KEY_HASH), *keys).agg(agg.alias("_row"))
    return out.select(hashed or KEY_HASH, *[F.col(k) for k in keys], *[F.col("_row." + c).alias(c) for c in order + rest]) \
              .select(hashed or KEY_HASH, *out_columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` (then by every other column)."""
    return keep_first_hashed(df, keys, order).drop(KEY_HASH)


def keep_first_hashed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keep_first`` with the key's hash in ``KEY_HASH``, by which the rows are dealt and sorted."""
    return _pick(df, keys, order, latest=False)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest by ``order`` (then by every other column).

    Rows with a ``KEY_HASH`` are grouped by it: it must be a function of the key.  They come from ``keep_first_hashed``
    by the same key and so are neither shuffled nor sorted again.
    """
    return _pick(df, keys, order, latest=True, hashed=KEY_HASH if KEY_HASH in df.columns else None).drop(KEY_HASH)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (``cnt``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)
