"""Secrets in texts: candidates by shape, false positives removed by a random forest.

A candidate is a value beside a naming word or an assignment, of any length and with any signs, or a long
word or word part without such a neighbour. It is described by its length, the transitions between kinds of characters, how much of it common words cover, whether it
looks like a path, and the words beside it. A random forest (Spark ML, trained on labelled findings)
tells secrets from identifiers, addresses and numbers. All of it are DataFrame functions.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffscope.session import materialize

#: Labelled findings that the forest is fitted on, at most.
TRAINING_ROWS = 20_000
LEAST = 16

# Words that code and prose use, for the coverage of a candidate.
DICTIONARY = (
    "account address admin agent alpha android apache api archive article author auth backup base beta build cache client code com common config content copy core css data date debug default demo dev doc docs download email en error event example export file files font format ftp git group home host html http https image images img import index info input item java javascript json key lib license line link list local login mail main master media menu message model module name net news node null number object old online open order org output page part password path photo php plugin post print product profile project public python query release remote report request resource root sample script search section secret server service session shop site source spring src static status store style sub system table tag temp template test text theme thread time title token tool tree type update upload url user util value version video view web wiki word work www xml"
).split()
# Words that name a secret.
NAMING = "(?i)(secret|token|api_?key|access_?key|private_?key|passw(or)?d|pwd|auth|bearer|credential|signature)"
# A value within a word, up to its closing quote, the next assignment or the end of the word.
_INNER = (
    "(?:[=:]>?|" + NAMING.replace("(?i)", "(?i:").replace("(or)?", "(?:or)?").replace("(secret", "(?:secret") + ")[\"'`]?[>|,(])[\"'`\\[({]{0,4}"
    "([^=:\"'`\\[({].*?)(?=[\"'`]|</|[,;&?][\"'`]?[A-Za-z_][A-Za-z0-9_.-]{0,64}[\"'`]?[=:]|[\\])},;.]{0,8}$)"
)
_EDGES = "^[\"'`<\\[({]+|[\"'`>\\])},;.:]+$"

FEATURES = [
    "length", "digits", "uppers", "lowers", "hexes", "signs", "runs_per_char", "distinct_per_char", "longest_letters", "covered", "slashes", "dots", "is_mail", "is_number", "named_before", "named_within", "assigned", "quoted", "word_before_length", "word_after_length",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word, part, finding, before, whole, after): one row per candidate, from the whole text."""
    words = F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), "[ \\t\\n\\x0B\\f\\r]+"), "")
    base = docs.select(F.col(id_col).alias("doc_id"), words.alias("w"))
    at = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    # named: the word beside it names a secret, or the one before assigns, or a name stands two words before
    naming = F.transform("w", lambda w: w.rlike(NAMING))
    marked = base.where(F.size("w") > 0).withColumn("names", naming).withColumn("signs", F.transform("w", lambda w: w.rlike("[=:]")))
    name = lambda i: F.coalesce(F.get("names", i), F.lit(False))
    beside = lambda i: name(i - 1) | name(i - 2) | name(i + 1) | at(i - 1).rlike("[=:]>?$")
    places = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: (F.length(F.get("w", i)) >= LEAST) | name(i) | F.get("signs", i) | beside(i))
    some = marked.withColumn("i", F.explode(places))
    i = F.col("i")
    near = some.select(
        "doc_id", i.cast("bigint").alias("word"), F.get("w", i).alias("whole"), beside(i).alias("beside"),
        F.concat_ws(" ", F.get("w", i - 2), F.get("w", i - 1)).alias("before"), at(i + 1).alias("after"),
    )
    quoted = F.regexp_extract("whole", "^([\"'`])(.+?)\\1", 2)
    bare = F.when(quoted != "", quoted).otherwise(F.regexp_replace("whole", _EDGES, ""))
    lone = F.when(F.length(bare) >= LEAST, F.array(bare)).otherwise(F.array().cast("array<string>"))
    value = F.when(F.col("beside"), F.array(bare)).otherwise(F.array().cast("array<string>"))
    parts = F.array_distinct(F.concat(F.regexp_extract_all("whole", F.lit("([A-Za-z0-9+/_=.@-]{16,})"), 1), value, lone, F.regexp_extract_all("whole", F.lit(_INNER), 1)))
    # signs alone, as in rules and arrows, are a value only where one is expected
    told = F.filter(parts, lambda p: p.rlike("[\\p{L}\\p{N}]") | (F.col("beside") & p.rlike("[^=:>|<.-]")))
    return near.select("doc_id", "word", "whole", "before", "after", F.posexplode(told).alias("part", "finding"))


def described(found: DataFrame) -> DataFrame:
    """The candidates with their features, all numbers."""
    f = F.col("finding")
    n = F.length(f).cast("double")
    share = lambda kind: F.length(F.regexp_replace(f, f"[^{kind}]", "")) / n
    runs = F.regexp_replace(F.regexp_replace(F.regexp_replace(f, "[0-9]+", "0"), "[a-z]+", "a"), "[A-Z]+", "A")
    letters = F.array_max(F.transform(F.split(f, "[^A-Za-z]+"), F.length))
    known = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    flag = lambda c: c.cast("double")
    columns: dict[str, Column] = {
        "length": n, "digits": share("0-9"), "uppers": share("A-Z"), "lowers": share("a-z"), "hexes": share("0-9a-fA-F"), "signs": share("+/_=.@-"),
        "runs_per_char": F.length(runs) / n,
        "distinct_per_char": F.size(F.array_distinct(F.split(f, ""))) / n,
        "longest_letters": letters.cast("double"),
        "covered": 1 - F.length(F.regexp_replace(F.lower(f), f"({known})", "")) / n,
        "slashes": share("/") * n, "dots": share(".") * n,
        "is_mail": flag(f.rlike("^[^@]+@[^@]+\\.[A-Za-z]+")), "is_number": flag(f.rlike("^[0-9.-]+$")),
        "named_before": flag(F.col("before").rlike(NAMING)), "named_within": flag(F.regexp_replace("whole", NAMING, "") != F.col("whole")),
        "assigned": flag(F.col("before").rlike("[=:]$") | F.col("whole").rlike("[=:]")),
        "quoted": flag(F.col("whole").rlike("[\"'`]")),
        "word_before_length": F.length(F.substring_index("before", " ", -1)).cast("double"), "word_after_length": F.length("after").cast("double"),
    }
    return found.select("doc_id", "word", "part", "finding", *(F.coalesce(columns[c], F.lit(0.0)).alias(c) for c in FEATURES))


def weak_labels(rows: DataFrame) -> DataFrame:
    """Findings that need no expert: 1 for random-looking values that are named and assigned as secrets,
    0 for mail addresses, plain numbers, host names, short plain words and values made of common words.
    Others stay open."""
    mixed = (F.col("uppers") > 0) & (F.col("lowers") > 0) & (F.col("runs_per_char") > 0.35) & (F.col("covered") < 0.3) & (F.col("length") >= 8)
    random = ((F.col("digits") > 0.15) | mixed) & (F.col("is_number") == 0) & (F.col("is_mail") == 0) & (F.col("runs_per_char") > 0.25)
    secret = random & (F.col("named_before") + F.col("named_within") > 0) & (F.col("assigned") == 1)
    word = F.col("finding").rlike("^\\p{L}[\\p{Ll}\\p{Lo}\\p{M}'-]*$") & (F.col("length") < LEAST)
    plain = word | (F.col("is_mail") == 1) | (F.col("is_number") == 1) | (F.col("covered") > 0.5) | ((F.col("dots") > 1) & (F.col("named_before") == 0))
    return rows.withColumn("secret", F.when(secret, 1.0).when(plain, 0.0)).where("secret is not null")


def fitted(labelled: DataFrame, trees: int = 20, depth: int = 6, seed: int = 1, most: int = TRAINING_ROWS) -> RandomForestClassificationModel | None:
    """The forest, or None where the findings show only one class. Fitted on ``most`` findings, by hash.

    Each class gets half of them, or more where the other has fewer; a finding weighs as many as it stands for.
    """
    counts = {k: n for k, n in labelled.where("secret is not null").groupBy("secret").agg(F.count("*")).collect()}
    if len(counts) < 2:
        return None
    rows = labelled.select("secret", *FEATURES, F.xxhash64(F.lit(seed), "doc_id", "word", "part", "finding").alias("h"))
    drawn = []
    for k, n in counts.items():
        take = min(n, max(most // 2, most - (sum(counts.values()) - n)))
        drawn.append(rows.where(F.col("secret") == k).orderBy("h", *FEATURES).limit(take).withColumn("weight", F.lit(n / take)))
    chosen = materialize(drawn[0].union(drawn[1]).drop("h"), "findings")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen)
    return RandomForestClassifier(labelCol="secret", featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed).fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """Every candidate with the forest's probability and verdict.

    ``labelled`` has described findings (see :func:`described`) with a column ``secret`` (1 or 0); without
    it the findings that :func:`weak_labels` settles are used. Returns doc_id, word (its place in the
    text), part (its place in the word), finding (first and last four characters, fewer of one below 16), finding_hash, the
    features, probability and is_secret.

    Null, empty and blank texts have no candidates. Where the labelled findings hold only one class, all
    candidates get the probability 1 if it is 1 or there are none, else 0: without knowledge nothing is
    ruled out. Rows with equal or null ids are scanned one by one. Empty tables give empty results; other
    columns are ignored.
    """
    rows = materialize(described(candidates(docs, id_col, text_col)), "candidates")
    known = weak_labels(rows) if labelled is None else labelled
    forest = fitted(known)
    shown = F.least(F.lit(4), F.floor(F.length("finding") / 4).cast("int"))
    masked = F.concat(F.left("finding", shown), F.lit("..."), F.right("finding", shown))
    if forest is None:
        sure = known.agg(F.coalesce(F.max("secret"), F.lit(1.0))).first()[0]
        told = rows.withColumn("p", F.lit(float(sure)))
    else:
        told = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
        told = told.withColumn("p", vector_to_array("probability")[1])
    return told.select("doc_id", "word", F.col("part").cast("bigint").alias("part"), masked.alias("finding"), F.sha2("finding", 256).alias("finding_hash"), *FEATURES, F.col("p").alias("probability"), (F.col("p") >= at_least).alias("is_secret"))
