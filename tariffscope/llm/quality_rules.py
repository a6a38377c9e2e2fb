"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document when a score is above a cutoff. For each stratum and rule, labelled good
documents are counted above each cutoff of a fixed ladder. A cutoff is certified when so few good ones
lie above it that, were the true share of wrongly rejected good documents above the limit, that count
would be this small with a chance below delta / (strata * rules * cutoffs): an exact binomial bound with
Bonferroni's correction, so all certificates hold at once with probability 1 - delta. Of the certified
cutoffs the one that catches the most labelled bad documents for the good ones it costs is used; without
one, the rule is idle in that stratum.

Everything is DataFrame functions; a text is read once and never leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffscope.session import materialize

_SPACE = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5

#: Scores, all of them "higher is worse", and the ladder of cutoffs for each.
RULES: dict[str, tuple[Column | str, list[float]]] = {
    "symbols_per_word": ("n_symbols / greatest(n_words, 1)", [i / 20 for i in range(1, 21)]),
    "bangs_per_word": ("n_bangs / greatest(n_words, 1)", [i / 20 for i in range(1, 21)]),
    "capitals_share": ("n_capitals / greatest(word_chars, 1)", [i / 20 for i in range(1, 20)]),
    "repeated_share": ("n_repeat_words / greatest(n_words, 1)", [i / 100 for i in range(1, 21)]),
    "duplicate_lines_share": ("n_dup_lines / greatest(n_lines, 1)", [i / 20 for i in range(1, 20)]),
}


def _less(text: str, drop: str) -> Column:
    return F.length(F.translate(F.col(text), drop, ""))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """One narrow row per document: id, stratum and counts over its whole text."""
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    base = docs.select(F.col(id_col).alias("doc_id"), stratum.alias("stratum"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    base = base.withColumn("w", F.array_remove(F.split("t", "[ \\t\\n\\x0B\\f\\r]+"), ""))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, _SPACE, "")) > 0)
    base = base.withColumn("l", lines)
    base = base.select(
        "doc_id",
        "stratum",
        F.size("w").cast("bigint").alias("n_words"),
        _less("t", _SPACE).cast("bigint").alias("word_chars"),
        (F.length("t") - _less("t", _SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.length("t") - _less("t", "!")).cast("bigint").alias("n_bangs"),
        (F.length("t") - _less("t", _CAPITALS)).cast("bigint").alias("n_capitals"),
        F.size("l").cast("bigint").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("w") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("w") - WINDOW + 1), lambda i: F.xxhash64(F.slice("w", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")).alias("h"),
    )
    # windows found twice or more, in their order: equal ones lie side by side once sorted by name
    base = base.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    twice = F.filter("s", lambda x, j: (x["h"] == F.get(F.col("s"), j - 1)["h"]) | F.coalesce(x["h"] == F.get(F.col("s"), j + 1)["h"], F.lit(False)))
    base = base.withColumn("p", F.when(F.col("s").isNotNull(), F.array_sort(F.transform(twice, lambda x: x["i"]))))
    # a window covers its words up to where the next one starts
    words = F.aggregate(
        "p",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("bigint").alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return base.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_bangs", "n_capitals", "n_lines", "n_dup_lines",
        F.coalesce(F.when(F.col("p").isNotNull(), words), F.lit(0).cast("bigint")).alias("n_repeat_words"),
    )


def binomial_log_tail(k: Column, n: Column, rate: float) -> Column:
    """The logarithm of P(X <= k) for X binomial with n trials; exact, for k below the mean."""
    odds = rate / (1 - rate)
    step = lambda a, i: F.struct(
        (a["l"] + F.log((n - i + 1) / i * odds)).alias("l"),
        (F.lit(1.0) + i / ((n - i + 1) * F.lit(odds)) * a["s"]).alias("s"),
    )
    start = F.struct((n * F.log(F.lit(1 - rate))).cast("double").alias("l"), F.lit(1.0).cast("double").alias("s"))
    many = F.when(k >= 1, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(many, start, step, lambda a: a["l"] + F.log(a["s"]))


def _place(rule: str, score: str, ladder: list[float]) -> Column:
    """Above how many cutoffs of its ladder a score is."""
    above = F.filter(F.array(*map(F.lit, ladder)), lambda cutoff: cutoff < F.expr(score))
    return F.struct(F.lit(rule).alias("rule"), F.size(above).alias("above"), F.lit(len(ladder)).alias("steps"))


def certified_cutoffs(
    rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", limit: float = 0.01, delta: float = 0.05, price: float = 20.0
) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_above, caught): the cutoff in use for each stratum and rule.

    ``rows`` come from :func:`measured`; only those above the base rules count. ``limit`` is the share of
    good documents a rule may wrongly reject in a stratum, ``price`` how many labelled bad shares a good
    share is worth when choosing among certified cutoffs.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("good"))
    scores = F.array(*[_place(rule, *rules) for rule, rules in RULES.items()])
    seen = rows.where(~base_failed()).join(known, "doc_id").select("stratum", "good", F.explode(scores).alias("s"))
    counts = seen.groupBy("stratum", "s.rule", "s.steps", F.col("s.above").alias("above")).agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    # a document above a cutoff is above all smaller ones
    step = counts.select("stratum", "rule", F.explode(F.sequence(F.lit(1), "steps")).alias("step")).distinct()
    above = step.join(counts, ["stratum", "rule"]).groupBy("stratum", "rule", "step").agg(
        F.sum(F.when(F.col("above") >= F.col("step"), F.col("good")).otherwise(0)).alias("n_above"),
        F.sum(F.when(F.col("above") >= F.col("step"), F.col("bad")).otherwise(0)).alias("caught"),
        F.sum("good").alias("n_good"),
        F.sum("bad").alias("n_bad"),
    )
    tests = F.count("*").over(Window.partitionBy())
    tested = above.withColumn("level", F.lit(delta) / tests)
    fine = (F.col("n_above") < F.col("n_good") * limit) & (binomial_log_tail(F.col("n_above"), F.col("n_good"), limit) <= F.log("level"))
    gain = F.col("caught") / F.greatest("n_bad", F.lit(1)) - price * F.col("n_above") / F.greatest("n_good", F.lit(1))
    best = tested.where(fine & (gain > 0)).groupBy("stratum", "rule").agg(F.max_by(F.struct("step", "n_good", "n_above", "caught"), F.struct(gain, "step")).alias("b"))
    ladders = F.create_map(*[x for r, (_, ladder) in RULES.items() for x in (F.lit(r), F.array(*map(F.lit, ladder)))])
    return best.select("stratum", "rule", F.get(ladders[F.col("rule")], F.col("b.step") - 1).alias("cutoff"), "b.n_good", "b.n_above", "b.caught")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", **limits) -> DataFrame:
    """Counts and verdict for every document.

    Returns doc_id, stratum, the counts of :func:`measured`, base_failed, rejected_by (the rules above
    their cutoffs, in the order of their names) and kept. Words are runs of anything but blanks and code
    points 9 to 13.

    A null text has no words and fails the base rules. A null stratum is a stratum of its own, named by
    the empty string. Labels may be missing, null or repeated (one 0 makes a document bad); a null id has
    no label. Rows with equal ids are judged one by one. Without labels only the base rules apply. Empty
    tables give empty results; other columns are ignored.
    """
    rows = materialize(measured(docs, id_col, text_col, stratum_col), "measured")
    cutoffs = certified_cutoffs(rows, labels, id_col, **limits)
    cutoffs = materialize(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")), "cutoffs")
    told = rows.join(cutoffs, "stratum", "left")
    over = [F.when(F.expr(e) > F.col("cutoffs")[r], F.lit(r)) for r, (e, _) in sorted(RULES.items())]
    told = told.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.array_compact(F.array(*over)))
    return told.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("cutoffs")
