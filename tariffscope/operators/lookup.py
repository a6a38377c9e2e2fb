"""Joining a fact to a lookup table whose size and skew are only known at run time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
HOT_KEY_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; a larger table keeps Spark's own choice."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def _on(keys: list[str], nullable: list[str]) -> Column:
    def equal(k: str) -> Column:
        return F.col(f"f.{k}").eqNullSafe(F.col(f"d.{k}")) if k in nullable else F.col(f"f.{k}") == F.col(f"d.{k}")

    return reduce(lambda a, b: a & b, [equal(k) for k in keys])


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    nullable: list[str] = (),
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``facts`` with the non-key columns of ``lookup``; ``lookup`` has one row per key.

    ``weight`` is the number of fact rows behind each lookup row, and ``lookup`` must be a written
    table because it is read more than once. Up to ``max_rows`` lookup rows are broadcast. Beyond
    that, keys with more than ``hot_rows`` facts and more than 1/max_rows of all facts are joined by
    broadcast - there can be no more than max_rows of them - and the other keys, now all small, go
    through a shuffle join.
    """
    added = [c for c in lookup.columns if c not in keys and c != weight]
    out = [*[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"d.{c}") for c in added]]
    on = _on(keys, list(nullable))

    def join(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
        return left.alias("f").join(right.alias("d"), on, kind)

    n_keys, total = lookup.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    if n_keys <= max_rows:
        return join(facts, F.broadcast(lookup), how).select(*out)

    bound = max(total / max_rows, hot_rows)
    hot = lookup.where(F.col(weight) > bound)
    if hot.isEmpty():
        return join(facts, lookup, how).select(*out)
    rest = lookup.where(F.col(weight) <= bound)
    from_hot = join(facts, F.broadcast(hot), "inner").select(*out)
    other_facts = join(facts, F.broadcast(hot.select(*keys)), "left_anti")
    return from_hot.unionByName(join(other_facts, rest, how).select(*out))
