"""Mapping raw payer and plan names to carriers and insurance types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffscope.functions.text import ascii_words
from tariffscope.operators.lookup import broadcast_if_small

#: Signs by which patterns are looked up.
GRAM = 3


def display_name(payer: Column) -> Column:
    """Without the trailing ``[1234]`` id and the ``ZZZ`` mark of retired payers."""
    return F.regexp_replace(F.regexp_replace(payer, r"\s*\[[0-9]+\]\s*\z", ""), "^ZZZ", "")


def is_retired(payer: Column) -> Column:
    return F.lower(payer).startswith("zzz")


def payer_pairs(staged: DataFrame) -> DataFrame:
    """Distinct payer/plan pairs with the number of charge rows behind each."""
    return (
        staged.where(F.col("payer_name").isNotNull())
        .groupBy("payer_name", "plan_name")
        .agg(F.count("*").alias("n_rows"))
    )


def cleanse(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns(
        {
            "payer_display_name": display_name(F.col("payer_name")),
            "is_retired_payer": is_retired(F.col("payer_name")),
        }
    )


def _match_inputs() -> tuple[Column, Column]:
    """What patterns are tried on, in order of trust: insurer name, then contract name."""
    return F.lower("payer_display_name"), F.lower(F.coalesce("plan_name", F.lit("")))


def _grams(text: Column, size: Column | int) -> Column:
    """All runs of ``size`` signs of a text; of no signs there is one."""
    last = F.length(text) - size + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(size))))


def pattern_index(patterns: DataFrame) -> DataFrame:
    """Each pattern with a ``gram`` that every text it matches must hold.

    The gram is up to GRAM signs of the pattern's longest piece without wildcards, the one that fewest
    patterns share; a pattern of wildcards alone has the empty gram.
    """
    pieces = F.regexp_extract_all("pattern", F.lit(r"(?s)((?:[^%_\\]|\\.)+)"), F.lit(1))
    plain = F.transform(pieces, lambda p: F.regexp_replace(p, r"(?s)\\(.)", "$1"))
    longest = F.reduce(plain, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    known = patterns.select("pattern", "payer_group", "priority", "product_line", longest.alias("_piece"))
    size = F.least(F.length("_piece"), F.lit(GRAM))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_piece") - size + 1), lambda i: F.substring("_piece", i, size)))
    rows = known.select("*", F.explode(grams).alias("gram")).drop("_piece")
    shared = rows.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = F.min_by("gram", F.struct("n", "gram")).alias("gram")
    return rows.join(shared, "gram").groupBy("pattern", "payer_group", "priority", "product_line").agg(rarest)


def candidates(cleansed: DataFrame, patterns: DataFrame) -> DataFrame:
    """Every pattern that matches a pair, on the insurer name (source 1) or the plan (source 2).

    Patterns are looked up by a run of signs that a text must hold for them to match, and only those are tried: the work
    does not grow with pairs times patterns.
    """
    index = broadcast_if_small(pattern_index(patterns))
    inputs = [F.struct(F.lit(i).alias("match_source"), text.alias("text")) for i, text in enumerate(_match_inputs(), start=1)]
    texts = cleansed.select("payer_name", "plan_name", F.inline(F.array(*inputs)))
    grams = F.array_distinct(F.flatten(F.array_compact(F.array(*[_grams(F.col("text"), n) for n in range(GRAM + 1)]))))
    found = texts.select("*", F.explode(grams).alias("gram")).join(index, "gram").where("text LIKE pattern")
    return found.select(
        "payer_name", "plan_name", "payer_group", F.col("product_line").alias("product_line_override"), "priority",
        F.length("pattern").alias("specificity"), "match_source", "pattern",
    )


def best_match(cleansed: DataFrame, patterns: DataFrame) -> DataFrame:
    """The winning pattern per pair; NULLs where nothing matches.

    The insurer name is trusted before the plan; then come priority, the longer pattern, the smaller text.
    """
    rank = F.struct("match_source", "priority", -F.col("specificity"), "pattern")
    won = F.min_by(F.struct("payer_group", "product_line_override", "match_source"), rank).alias("won")
    best = candidates(cleansed, patterns).groupBy("payer_name", "plan_name").agg(won)
    c, b = cleansed.alias("c"), best.alias("b")
    same = (F.col("c.payer_name") == F.col("b.payer_name")) & F.col("c.plan_name").eqNullSafe(F.col("b.plan_name"))
    return c.join(b, same, "left").select(
        "c.*", F.col("won.payer_group").alias("matched_group"), "won.product_line_override", "won.match_source"
    )


# The word lists and labels of the cascade, first hit wins; \b borders a word of ASCII signs.
LINE_RULES = (
    ("plan", r"\bva\b|veteran|tricare", "Other government"),
    ("payer", r"medicaid|masshealth|\baco\b|\bmco\b|\bmcd\b", "Medicaid"),
    ("payer", r"medicare|\bsco\b|senior|wellcare|eternal", "Medicare Advantage"),
    ("plan", r"commercial|connector|qhp", "Commercial"),
    ("plan", r"medicaid|masshealth", "Medicaid"),
    ("plan", r"medicare", "Medicare Advantage"),
)


def product_line(override: Column, payer: Column, plan: Column) -> Column:
    """Insurance type; the first arm that fits decides."""
    texts = {"payer": F.lower(payer), "plan": F.lower(F.coalesce(plan, F.lit("")))}
    line = F.when(override.isNotNull(), override)
    for side, words, label in LINE_RULES:
        line = line.when(texts[side].rlike(ascii_words(words)), label)
    return line.otherwise("Commercial")


def payer_key(payer: Column, plan: Column) -> Column:
    return F.md5(F.concat(payer, F.lit("|"), F.coalesce(plan, F.lit(""))))


def payer_dimension(pairs: DataFrame, patterns: DataFrame) -> DataFrame:
    """One row per raw payer/plan pair; keeps ``n_rows`` for the fact join."""
    return best_match(cleanse(pairs), patterns).select(
        payer_key(F.col("payer_name"), F.col("plan_name")).alias("payer_key"),
        "payer_name",
        "plan_name",
        "payer_display_name",
        "is_retired_payer",
        F.coalesce("matched_group", F.lit("Other")).alias("payer_group"),
        "match_source",
        product_line(
            F.col("product_line_override"), F.col("payer_display_name"), F.col("plan_name")
        ).alias("product_line"),
        "n_rows",
    )
