"""Column-level helpers (all JVM-side built-in expressions, no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas as S


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_hash(*cols: Column | str, names: Sequence[str] | None = None) -> Column:
    """Functional change hash: SHA-256 of the JSON rendering of the named columns.

    NULL fields are left out of the JSON, so adding a NULL column keeps the hash.
    """
    if names is None:
        names = [c if isinstance(c, str) else None for c in cols]
        if any(n is None for n in names):
            raise ValueError("pass names= when hashing computed columns")
    fields = [as_col(c).alias(n) for c, n in zip(cols, names)]
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def hash_bucket(cols: Sequence[Column | str], salt: str | None, n: int) -> Column:
    """Deterministic bucket 0..n-1 from a salted xxhash64 (partition-independent)."""
    parts = [as_col(c) for c in cols]
    if salt is not None:
        parts.append(F.lit(salt))
    return F.pmod(F.xxhash64(*parts), F.lit(n))


def pick_by_hash(values: Sequence, cols: Sequence[Column | str], salt: str | None) -> Column:
    """Deterministic categorical assignment: element of ``values`` chosen by hash bucket."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (hash_bucket(cols, salt, len(values)) + 1).cast("int"))


def hash_sample(df: DataFrame, cols: Sequence[Column | str], salt: str | None, pct: int) -> DataFrame:
    """Keep the rows whose salted hash bucket (0..99) is below ``pct``.

    Seedless and independent of partitioning: the same key is always in or out.
    """
    return df.where(hash_bucket(cols, salt, 100) < F.lit(pct))


def event_key(*cols: Column | str, sep: str = "|") -> Column:
    """Content key of an event: SHA-256 of the fields joined by ``sep``."""
    return F.sha2(F.concat_ws(sep, *[as_col(c) for c in cols]), 256)


def quarantine_key(key: Column | str, path: Column | str, rank: Column | str) -> Column:
    """Surrogate id of a rejected row: hash of key, source path and duplicate rank."""
    return F.sha2(F.concat_ws(
        S.QUARANTINE_KEY_SEPARATOR,
        F.coalesce(as_col(key).cast("string"), F.lit(S.NULL_KEY_TEXT)),
        F.coalesce(as_col(path), F.lit(S.NULL_KEY_TEXT)),
        as_col(rank).cast("string"),
    ), 256)


def guarded_ratio(num: Column, den: Column, dtype: str) -> Column:
    """``num / den`` cast to ``dtype``; 0 when the denominator is 0."""
    return F.when(den == 0, F.lit(0).cast(dtype)).otherwise((num / den).cast(dtype))


def risk_premium(rating: Column | str, premiums: dict | None = None,
                 default=None) -> Column:
    premiums = S.RISK_PREMIUMS if premiums is None else premiums
    default = S.DEFAULT_RISK_PREMIUM if default is None else default
    expr = None
    for k, v in premiums.items():
        cond = as_col(rating) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def int_sum_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as BIGINT."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
