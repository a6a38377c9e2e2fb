"""Mixing to target shares by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). The cells are raked: each dimension in turn is
scaled to its target shares, until all hold. The calibrated tokens of a cell over its actual ones are the
weight of its documents, and a document's probability is its weight over the largest one. So expected
tokens have exactly the target shares and no document is needed twice.

Documents are read once into narrow rows. Raking works on cells, as Spark joins with sums per value; what
reaches the driver is one number per round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffscope.session import materialize

DIMENSIONS = ("source", "lang", "topic")
#: Target shares follow natural ones raised to this power, which lifts rare values.
TEMPERATURE = 0.7
ROUNDS = 30
CLOSE = 1e-6


def _is(k: int):
    return lambda c: c == k


def topic_of(text: Column, topics: int = 8, least: int = 7) -> Column:
    """A topic by vocabulary: long words fall into classes by hash, the fullest class names the text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: F.length(w) >= least)
    classes = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(topics)).cast("int"))

    def fullest(own: Column) -> Column:
        return F.array_max(F.array(*[F.struct(F.size(F.filter(own, _is(k))).alias("n"), F.lit(-k).alias("k")) for k in range(topics)]))

    # most words first, then the smaller class; the outer array names the classes once
    best = F.get(F.transform(F.array(classes), fullest), 0)
    return F.when(best["n"] > 0, F.concat(F.lit("t"), (-best["k"]).cast("string"))).otherwise("")


def tempered(cells: DataFrame, dimension: str, power: float = TEMPERATURE) -> DataFrame:
    """(value, share): natural shares raised to a power."""
    return cells.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("share"))


def _with_targets(cells: DataFrame, targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Token totals per value of each dimension: shares of the values that occur, scaled to all tokens."""
    out = {}
    for d, shares in targets.items():
        present = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("own"))
        wanted = shares.groupBy("value").agg(F.sum("share").alias("share"))
        both = present.join(wanted, present["value"].eqNullSafe(wanted["value"])).select(present["value"], "own", "share")
        totals = both.where("share > 0").agg(F.sum("share").alias("shares"))
        tokens = cells.agg(F.sum("tokens").alias("all"))
        out[d] = materialize(both.where("share > 0").join(F.broadcast(totals)).join(F.broadcast(tokens)).select(F.col("value").alias(d), (F.col("share") / F.col("shares") * F.col("all")).alias("goal")), f"goal_{d}")
    return out


def raked(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """The cells with ``weight``: calibrated over actual tokens. Cells of a value without a target weigh 0."""
    goals = _with_targets(cells, targets)
    aims = [goal.select(F.lit(d).alias("dimension"), F.col(d).alias("value"), "goal") for d, goal in goals.items()]
    aims = materialize(reduce(DataFrame.unionByName, aims), "goals")
    now = cells.withColumn("weight", F.lit(1.0))
    for _ in range(rounds):
        for d, goal in goals.items():
            sums = now.groupBy(d).agg(F.sum(F.col("weight") * F.col("tokens")).alias("sum"))
            scale = sums.join(goal, d).select(d, F.when(F.col("sum") > 0, F.col("goal") / F.col("sum")).otherwise(0.0).alias("scale"))
            now = now.join(scale, d, "left").select(*cells.columns, (F.col("weight") * F.coalesce("scale", F.lit(0.0))).alias("weight"))
        now = materialize(now, "cells")
        # all marginals in one small job: every cell counts for its value of each dimension
        entries = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value"), (F.col("weight") * F.col("tokens")).alias("tokens")) for d in goals])
        sums = now.select(F.inline(entries)).groupBy("dimension", "value").agg(F.sum("tokens").alias("sum"))
        off = sums.join(aims, ["dimension", "value"]).agg(F.max(F.abs(F.col("sum") / F.col("goal") - 1))).first()[0] or 0.0
        if off < CLOSE:
            break
    return now


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: dict[str, Column] | None = None,
    targets: dict[str, DataFrame] | None = None, seed: int = 1, rounds: int = ROUNDS,
    full_weight: float | None = None, luck_col: str | None = None,
) -> DataFrame:
    """Weight, probability and choice of every document.

    ``dimensions`` names the marginals and how they are read from a row; ``targets`` has a table (value,
    share) for each, by default natural shares raised to the power 0.7. Returns doc_id, the dimensions,
    tokens (words), weight, probability and sampled. The choice depends on the document and the seed only:
    on its text and its id, or ``luck_col`` where the id is a mere row key.

    ``full_weight`` is the weight from which on a document is kept for sure; by default the largest one, so
    that expected tokens have the target shares exactly, however few documents that leaves. A smaller one
    keeps more: cells above it give all they have, which is less than their share, the others keep their
    proportions to each other.

    A null value of a dimension is the value "" (so a null source is a source). A text without words has no tokens and gets the
    weight of its cell; cells without tokens keep weight 1 of their own. Rows with equal id and text are
    chosen together. Values without a target weigh 0; targets of values that do not occur are shared out
    among the others. Empty tables give empty results.
    """
    named = {d: F.coalesce(c.cast("string"), F.lit("")) for d, c in (dimensions or {d: F.col(d) for d in DIMENSIONS}).items()}
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.size(F.array_remove(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), ""))
    luck = F.pmod(F.xxhash64(F.lit(seed), F.col(luck_col or id_col), text), F.lit(1 << 52)) / F.lit(float(1 << 52))
    rows = materialize(docs.select(F.col(id_col).alias("doc_id"), *(c.alias(d) for d, c in named.items()), words.cast("bigint").alias("tokens"), luck.alias("luck")), "tokens")
    keys = list(named)
    cells = materialize(rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "cells")
    weights = raked(cells, targets or {d: tempered(cells, d) for d in keys}, rounds)
    most = full_weight or weights.where("tokens > 0").agg(F.max("weight")).first()[0] or 1.0
    told = rows.join(weights.select(*keys, "weight"), keys)
    probability = F.least(F.lit(1.0), F.col("weight") / F.lit(most))
    return told.select("doc_id", *keys, "tokens", "weight", probability.alias("probability"), (F.col("luck") < probability).alias("sampled"))
