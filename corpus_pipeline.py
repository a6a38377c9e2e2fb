"""A training corpus from the documents table, stage by stage.

Each stage reads all that its predecessor kept, which was written as Parquet. All but the last return the
columns of documents. Verdicts are joined by a row key, never by id: ids may be null or repeated.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffscope.llm import decontaminate, jaccard_join, mixing, quality_rules, sharding
from tariffscope.operators.lookup import broadcast_if_small
from tariffscope.session import materialize

#: Numbers of 64 verdicts each that are broadcast: 16 bytes each, 32 MB in all.
MARKED_CHUNKS = 2_000_000


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with ``_row``, a unique key: ids may be null or repeated. Its place in its Parquet file, or else written down."""
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at"))
    except AnalysisException:
        return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    paths = sorted(r[0] for r in placed.select("_path").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(enumerate(paths)), "_file bigint, _path string")
    row = F.shiftleft("_file", 40) + F.col("_at")
    return placed.join(F.broadcast(numbers), "_path").select(*docs.columns, row.alias("_row"))


def _chosen(docs: DataFrame, rows: DataFrame, keep: bool) -> DataFrame:
    """The keyed documents whose ``_row`` is (or, without ``keep``, is not) among ``rows``, without the key.

    Verdicts become one bit for each row, 64 to a number, so that the texts stay where they are: the bits of
    MARKED_CHUNKS numbers, some hundred million rows, are broadcast once they are counted. Only beyond that the texts are shuffled.
    """
    bit = F.expr("shiftleft(1L, CAST(pmod(_row, 64) AS INT))")
    chunk = F.shiftright("_row", 6)
    marks = rows.groupBy(chunk.alias("_chunk")).agg(F.bit_or(bit).alias("_bits"))
    marks = broadcast_if_small(materialize(marks, "marks"), MARKED_CHUNKS)
    marked = docs.withColumn("_chunk", chunk).join(marks, "_chunk", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    return marked.where(hit if keep else ~hit).drop("_row", "_chunk", "_bits")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    docs = _keyed(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("quality").isin(0, 1))
    known = docs.select("_row", "doc_id").join(labels.groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id")
    told = materialize(quality_rules.judged(docs, known, id_col="_row").select(F.col("doc_id").alias("_row"), "kept"), "verdicts")
    return _chosen(docs, told.where("not kept"), keep=False)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id, the first of those with equal ids."""
    docs = _keyed(docs)
    found = jaccard_join.near_duplicates(docs, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id")
    ids = materialize(found, "classes").join(docs.select("_row", "doc_id"), "_row")
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first"))
    return _chosen(docs, materialize(first.select("first._row"), "firsts"), keep=True)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    docs = _keyed(docs)
    leaks = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="_row")
    return _chosen(docs, materialize(leaks.select(F.col("doc_id").alias("_row")), "leaks"), keep=False)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target shares of sources, languages and topics.

    Those of cells below their share all stay; only cells above it are thinned out.
    """
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}
    docs = _keyed(docs)
    told = mixing.mix(docs, id_col="_row", dimensions=dimensions, full_weight=1.0, luck_col="doc_id")
    told = materialize(told.select(F.col("doc_id").alias("_row"), "sampled"), "choices")
    return _chosen(docs, told.where("sampled"), keep=True)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", deduplicated),
    ("decontaminate", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Raking and label propagation iterate, and cutoffs are fitted: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
