"""Documents packed into blocks: one row holds some megabytes of text.

Duplicate search needs every text several times, each time with what the other texts have answered in
between. A block is the unit of that exchange: it asks once for each distinct key it holds, however often
the key occurs in it, and gets one answer. The blocks are a table bucketed by block in the shared folder,
so a join with the answers moves the answers only and the text lies still.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.session import materialize, package_on_workers, shared_dir

#: Bytes of text after which a block is closed. A longer text has a block of its own.
BLOCK_BYTES = 4 << 20
#: Text that one task reads from the bucketed table, about.
BUCKET_BYTES = 24 << 20
#: Stands for a null doc_id inside numpy arrays; it sorts before all others.
NO_ID = np.iinfo(np.int64).min

PACKED = "block bigint, ids array<bigint>, lengths array<bigint>, body binary, n_bytes bigint"
ANSWERS = "block bigint, bucket int, body binary"


@dataclass
class Block:
    """The texts of a block in the order of their ids (ties: the order they were read in)."""

    number: int
    ids: np.ndarray
    texts: list[bytes]
    null: np.ndarray
    answers: dict[int, bytes]

    def id_column(self, rows: np.ndarray | None = None) -> pa.Array:
        ids = self.ids if rows is None else self.ids[rows]
        return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def _packed(number: int, ids: list, texts: list) -> pa.RecordBatch:
    ids_ = np.array([NO_ID if i is None else i for i in ids], np.int64)
    order = np.argsort(ids_, kind="stable")
    texts = [texts[i] for i in order]
    body = zstandard.ZstdCompressor(3).compress(b"".join(t or b"" for t in texts))
    lengths = [-1 if t is None else len(t) for t in texts]
    columns = [[number], [[None if i == NO_ID else int(i) for i in ids_[order]]], [lengths], [body], [sum(map(len, filter(None, texts)))]]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "ids", "lengths", "body", "n_bytes"]
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 20
    ids: list = []
    texts: list = []
    size = 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            ids.append(i)
            texts.append(t)
            size += len(t or b"") + 64
            if size >= BLOCK_BYTES:
                yield _packed(number, ids, texts)
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield _packed(number, ids, texts)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as a table of blocks, bucketed by block in the shared folder."""
    spark = docs.sparkSession
    package_on_workers(spark)
    pairs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    size = pairs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    name = f"blocks_{uuid.uuid4().hex}"
    # no fewer buckets than shuffle partitions, or a join would rather move the blocks
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    (
        pairs.mapInArrow(_pack, PACKED)
        .write.format("parquet")
        .option("compression", "none")
        .option("path", f"{shared_dir(spark)}/{name}")
        .bucketBy(buckets, "block")
        .sortBy("block")
        .saveAsTable(name)
    )
    return spark.table(name)


def text_bytes(blocks: DataFrame) -> int:
    return blocks.agg(F.sum("n_bytes")).first()[0] or 0


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks of a task, one after the other."""
    for batch in batches:
        names = batch.schema.names
        for row in range(batch.num_rows):
            get = lambda c, row=row, batch=batch, names=names: batch.column(names.index(c))[row]
            ids = get("ids").values
            lengths = np.asarray(get("lengths").values)
            body = zstandard.ZstdDecompressor().decompress(get("body").as_py(), max_output_size=max(1, get("n_bytes").as_py()))
            ends = np.cumsum(np.maximum(lengths, 0))
            texts = [body[e - max(n, 0) : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            answers = {}
            if "answers" in names and get("answers").is_valid:
                answers = {a["bucket"]: a["body"] for a in get("answers").as_py()}
            yield Block(get("block").as_py(), np.asarray(ids.fill_null(NO_ID)), texts, lengths < 0, answers)


def bucket_bits(n_bytes: int, per_bucket: int = 8 << 20) -> int:
    """So many leading bits of a key that the keys of one bucket take about ``per_bucket`` bytes."""
    return max(3, int(np.ceil(np.log2(max(1, n_bytes / per_bucket)))))


def ask(
    blocks: DataFrame,
    questions: Callable[[Block], Iterator[tuple[int, list[bytes]]]],
    answer: Callable[[list[int], list[list[bytes]]], list[bytes]],
    fields: int,
    name: str,
) -> DataFrame:
    """Send every block's questions to their buckets and add the answers to the blocks.

    ``questions`` gives (bucket, fields) for a block; ``answer`` gets all questions of one bucket, with
    their block numbers, and returns one answer for each. A bucket is a group of keys, sized by the
    data; a frequent key takes one entry per block in it.
    """
    columns = [f"f{i}" for i in range(fields)]
    kinds = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in columns)])
    reply = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("body", pa.binary())])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in opened(batches):
            rows = list(questions(block))
            if rows:
                data = [[b for b, _ in rows], [block.number] * len(rows), *([f[i] for _, f in rows] for i in range(fields))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(data, kinds.types, strict=True)], schema=kinds)

    def replied(key: tuple, table: pa.Table) -> pa.Table:
        numbers = table.column("block").to_pylist()
        bodies = answer(numbers, list(zip(*(table.column(c).to_pylist() for c in columns), strict=True)))
        return pa.table([pa.array(numbers, pa.int64()), pa.array([key[0].as_py()] * len(numbers), pa.int32()), pa.array(bodies, pa.binary())], schema=reply)

    asked = blocks.select("block", "ids", "lengths", "body", "n_bytes", *(c for c in blocks.columns if c == "answers"))
    schema = ", ".join(["bucket int", "block bigint", *(f"{c} binary" for c in columns)])
    replies = materialize(asked.mapInArrow(sent, schema).groupBy("bucket").applyInArrow(replied, ANSWERS), name)
    return replies


def with_answers(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """Blocks with all their answers; the bucketed blocks are not moved."""
    rows = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "body")).alias("answers"))
    return blocks.join(rows, "block", "left")


# Keys that occur more than once


@dataclass
class Keys:
    """The distinct keys of a block, cut into buckets by their leading bits."""

    distinct: np.ndarray
    inverse: np.ndarray
    often: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, bits: int) -> Keys:
        distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        bounds = np.searchsorted(distinct >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        return cls(distinct, inverse, counts > 1, bounds)

    def questions(self, bits: int) -> Iterator[tuple[int, list[bytes]]]:
        """Per bucket the next 32 bits of each key: enough for a filter, as buckets hold some million keys."""
        short = (self.distinct >> np.uint64(32 - bits)).astype(np.uint32)
        for bucket in np.flatnonzero(np.diff(self.bounds)).tolist():
            yield bucket, [short[self.bounds[bucket] : self.bounds[bucket + 1]].tobytes()]

    def shared(self, answers: dict[int, bytes]) -> np.ndarray:
        """For every key as given: does it occur twice or more, here or with another block's?"""
        flags = self.often.copy()
        for bucket, body in answers.items():
            at, upto = self.bounds[bucket], self.bounds[bucket + 1]
            flags[at:upto] |= np.unpackbits(np.frombuffer(body, np.uint8), count=upto - at).astype(bool)
        return flags[self.inverse] if len(self.inverse) else np.zeros(0, bool)


def seen_twice(numbers: list[int], rows: list[list[bytes]]) -> list[bytes]:
    """For each block's keys in a bucket a bit: does another block have the key too?"""
    parts = [np.frombuffer(r[0], np.uint32) for r in rows]
    keys = np.concatenate(parts)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    twice = np.zeros(len(keys), bool)
    equal = ranked[1:] == ranked[:-1]
    twice[1:] |= equal
    twice[:-1] |= equal
    flags = np.empty(len(keys), bool)
    flags[order] = twice
    return [np.packbits(f).tobytes() for f in np.split(flags, np.cumsum([len(p) for p in parts])[:-1])]
