"""Deterministic "keep first" deduplication.

``keep_first`` is an aggregation, not a window: ``min(struct(order..., row))``
per key is combined map-side, so a hot key (even a third of all rows) is
collapsed inside each input task before the shuffle and never lands in one
sort.  Ties on the order columns are broken by the rest of the row, so the
result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame,
    keys: list[str | Column],
    order: list[str | Column],
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per distinct key: the row with the smallest ``order``.

    Null keys form one group (pandas ``drop_duplicates``); with
    ``keep_null_keys`` every row with a null key is kept instead.
    """
    cols = df.columns
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [f"_k{i}" for i in range(len(key_cols))]
    ord_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    work = df.select(
        *[k.alias(n) for k, n in zip(key_cols, key_names)],
        F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(ord_cols)], *[F.col(f"`{c}`") for c in cols]).alias("_r"),
    )
    if keep_null_keys:
        any_null = F.lit(False)
        for n in key_names:
            any_null = any_null | F.col(n).isNull()
        nulls = work.where(any_null).select("_r")
        work = work.where(~any_null)
    # plain-column keys come back from the grouping attributes (not from the
    # struct) so the output keeps the shuffle's hash partitioning on them
    plain = {k: n for k, n in zip(keys, key_names) if isinstance(k, str) and not k.startswith("`") and k in cols}
    best = work.groupBy(*key_names).agg(F.min("_r").alias("_r"))
    out = best.select(*[F.col(plain[c]).alias(c) if c in plain else F.col(f"_r.`{c}`").alias(c) for c in cols])
    if keep_null_keys:
        out = out.unionByName(nulls.select(*[F.col(f"_r.`{c}`").alias(c) for c in cols]))
    return out
