"""Alignment of two tokenizers over a corpus, with document counts of every linked token pair.

Both tokenizers cut a text (a space put in front) into byte ranges. Offsets where both cut bound the groups;
tokens of the two sides whose ranges overlap are linked. How many documents link a pair is counted by external
spill counting:

* Records (A id, B id, document, occurrences) of a block of texts are sorted side-major and radix-partitioned by
  the low bits of the A id into runs: pairs with their number of documents, compressed, and beside them the
  documents. The documents stay with their block; one entry per pair and block travels, however many documents
  of the block have the pair, so a pair that is in every document costs no more than a rare one.
* A group of at most about FAN_IN runs of one radix meets in a task: a heap merges them in the order of the keys
  and adds up each pair. Where there are more runs, merged runs are merged again, level by level.
* The last level has all pairs of an A id side by side, so their maximum is known as soon as the next A id comes, and
  the totals stream back into the runs they came from, down the levels, and from a block's runs into its documents.

Defined results: texts null, empty, or whose tokens on either side don't spell the text exactly have zeros and the
empty string. Ties for the highest count all count as best. Rows are documents: repeated rows and null ids are rows
like others. Extra columns of the input do not matter. An empty table gives no rows. A text longer than a block is a block of its own.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.llm import piece_codec
from tariffscope.session import materialize, package_on_workers

#: Bytes of text after which a block is closed.
BLOCK_BYTES = 2 << 20
#: Parts by the low bits of the A id.
RADIX = 128
#: Runs that one task merges, about.
FAN_IN = 128
#: Pairs in a compressed frame, the unit in which a run is read.
FRAME = 2048
#: Bits for a document's place in its block and for a pair.
_DOC_BITS, _PAIR_BITS = 20, 36

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# Tokenizers


def _byte_signs() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a visible sign: itself where it is one, else the next from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library. No pre-token reaches from a visible sign into white space
    after it, so each distinct chunk of white space and word is encoded once."""

    _CHUNK = re.compile(r"\s*\S+|\s+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        signs = _byte_signs()
        self.token_bytes = [b""] * self.library.get_vocab_size()
        for token, number in self.library.get_vocab().items():
            self.token_bytes[number] = bytes(signs[s] for s in token) if all(s in signs for s in token) else token.encode()
        self.sizes = np.array([len(t) for t in self.token_bytes])
        self.has_every_byte = {bytes([b]) for b in range(256)} <= set(self.token_bytes) and self.library.normalizer is None
        self.memory = piece_codec.Memory(self._chunks)

    def _one(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _chunks(self, chunks: list[str]) -> list[tuple[int, ...]]:
        # chunks that start with white space and end with a sign can stand in one text
        together = [c for c in chunks if c[0].isspace() and not c[-1].isspace()]
        ids = self._one("".join(together))
        ends = np.cumsum(self.sizes[ids]) if ids else np.zeros(0, np.int64)
        wanted = np.cumsum([len(c.encode()) for c in together])
        cut = np.searchsorted(ends, wanted) + 1
        if not np.array_equal(ends[cut - 1], wanted):
            return [tuple(self._one(c)) for c in chunks]
        found = {c: tuple(ids[a:b]) for c, a, b in zip(together, [0, *cut.tolist()], cut.tolist(), strict=False)}
        return [found[c] if c in found else tuple(self._one(c)) for c in chunks]

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self._CHUNK.findall(t) for t in texts]
        get = self.memory.all(chain.from_iterable(cut)).__getitem__
        return [list(chain.from_iterable(map(get, c))) for c in cut]


def _spelt(table: list[bytes], ids: list[int]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


class Aligner:
    """Both tokenizers and the tables that go with them."""

    def __init__(self, byte_level: str, pieces: str):
        self.a = ByteLevel(byte_level)
        self.b = piece_codec.codec(pieces)
        self.b_sizes = np.array([len(t) for t in self.b.token_bytes])
        n_a, self.n_b = len(self.a.token_bytes), len(self.b.token_bytes)
        if n_a * self.n_b >> _PAIR_BITS:
            raise ValueError("vocabularies too large for a pair number")
        #: Token as it stands inside a side of a group, and as its last one.
        self.written = [f"{i}{s}" for i in range(n_a) for s in ",|"] + [f"{i}{s}" for i in range(self.n_b) for s in ",;"]
        self.b_from = 2 * n_a

    def cut(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[int]], list[list[int]]]:
        """Rows that have tokens, and the tokens of both sides for these."""
        rows = [i for i, t in enumerate(texts) if t]
        plain = [texts[i] for i in rows]
        a = self.a.encode([" " + t for t in plain])
        b = self.b.library.encode(plain, num_threads=1)
        wholes = [b" " + t.encode() for t in plain]
        # a byte-level vocabulary that has every byte can only spell the text
        good = range(len(plain)) if self.a.has_every_byte else [k for k, w in enumerate(wholes) if _spelt(self.a.token_bytes, a[k]) == w]
        good = [k for k in good if _spelt(self.b.token_bytes, b[k]) == wholes[k]]
        return np.array([rows[k] for k in good], np.int64), [a[k] for k in good], [b[k] for k in good]

    def align(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray]:
        """Counts per text, groups as text, and for every link its pair and its row."""
        counts = {c: np.zeros(len(texts), np.int64) for c in _COUNTS}
        groups = [""] * len(texts)
        rows, a_lists, b_lists = self.cut(texts)
        if not len(rows):
            return counts, groups, np.zeros(0, np.int64), np.zeros(0, np.int64)
        n_a, n_b = np.array([len(x) for x in a_lists]), np.array([len(x) for x in b_lists])
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, n.sum()) for x, n in ((a_lists, n_a), (b_lists, n_b)))
        a_ends, b_ends = np.cumsum(self.a.sizes[a]), np.cumsum(self.b_sizes[b])
        cut_a, cut_b = np.zeros(a_ends[-1] + 1, bool), np.zeros(a_ends[-1] + 1, bool)
        cut_a[a_ends] = cut_b[b_ends] = True
        cut_both = cut_a & cut_b
        both = np.flatnonzero(cut_both)
        # between two neighbouring cuts lies one token of each side: one link
        each = np.flatnonzero(cut_a | cut_b)
        # cuts of each kind before a byte: the number of the token, or group, that it lies in
        a_before, b_before, g_before = (np.cumsum(c, dtype=np.int32) - c for c in (cut_a, cut_b, cut_both))
        upto = a_ends[np.cumsum(n_a) - 1]
        doc_ends = np.zeros(len(cut_a), bool)
        doc_ends[upto] = True
        owner = (np.cumsum(doc_ends, dtype=np.int32) - doc_ends)[each]
        pairs = a[a_before[each]] * self.n_b + b[b_before[each]]
        counts["n_a"][rows], counts["n_b"][rows] = n_a, n_b
        counts["n_groups"][rows] = np.diff(g_before[upto], prepend=-1)
        counts["n_links"][rows] = np.bincount(owner, minlength=len(rows))
        # where each token stands in the written groups: A tokens of a group, then its B tokens
        a_group, b_group = g_before[a_ends], g_before[b_ends]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.r_[0, b_before[both] + 1][a_group]] = 2 * a + cut_b[a_ends]
        order[np.arange(len(b)) + a_before[both][b_group] + 1] = self.b_from + 2 * b + cut_a[b_ends]
        written, at = list(map(self.written.__getitem__, order.tolist())), 0
        for row, n in zip(rows.tolist(), (n_a + n_b).tolist(), strict=True):
            groups[row] = "".join(written[at : at + n])[:-1]
            at += n
        return counts, groups, pairs, rows[owner]


@functools.cache
def aligner(byte_level: str, pieces: str) -> Aligner:
    return Aligner(byte_level, pieces)


# Runs


def _planes(values: np.ndarray) -> bytes:
    """Integers byte by byte, all lowest bytes first: high bytes are nearly always zero and cost nothing."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(body: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(8, n).T).view("<u8").reshape(n).astype(np.int64)


def _squeezed(*columns: np.ndarray) -> bytes:
    body = zstandard.ZstdCompressor(3).compress(b"".join(map(_planes, columns)))
    return struct.pack("<II", len(columns[0]), len(body)) + body


def _opened(body: bytes, columns: int, at: int = 0) -> tuple[list[np.ndarray], int]:
    n, size = struct.unpack_from("<II", body, at)
    at += 8
    raw = zstandard.ZstdDecompressor().decompress(body[at : at + size], max_output_size=max(1, 8 * n * columns))
    return [_from_planes(raw[8 * n * i : 8 * n * (i + 1)], n) for i in range(columns)], at + size


def write_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys with their counts, in frames."""
    frames = range(0, len(keys), FRAME)
    return b"".join(_squeezed(np.diff(keys[i : i + FRAME], prepend=0), counts[i : i + FRAME]) for i in frames)


def read_run(body: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(body):
        (steps, counts), at = _opened(body, 2, at)
        yield np.cumsum(steps), counts


def whole_run(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    frames = list(read_run(body)) or [(np.zeros(0, np.int64),) * 2]
    return np.concatenate([f[0] for f in frames]), np.concatenate([f[1] for f in frames])


def merged(bodies: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
    """Key, total and the runs that have the key, in the order of the keys: a k-way merge over a heap."""

    def entries(body: bytes, run: int) -> Iterator[tuple[int, int, int]]:
        for keys, counts in read_run(body):
            yield from zip(keys.tolist(), [run] * len(keys), counts.tolist(), strict=True)

    now, total, runs = -1, 0, []
    for key, run, count in heapq.merge(*(entries(b, i) for i, b in enumerate(bodies))):
        if key != now:
            if runs:
                yield now, total, runs
            now, total, runs = key, 0, []
        total += count
        runs.append(run)
    if runs:
        yield now, total, runs


def merge_runs(bodies: list[bytes]) -> bytes:
    keys, totals = array("q"), array("q")
    for key, total, _ in merged(bodies):
        keys.append(key)
        totals.append(total)
    return write_run(np.asarray(keys, np.int64), np.asarray(totals, np.int64))


def answer_runs(bodies: list[bytes], n_b: int) -> list[bytes]:
    """For each run the corpus-wide total of each of its keys, doubled, plus one where it is its A id's highest."""
    out = [array("q") for _ in bodies]
    side, waiting = -1, []

    def give_back() -> None:
        best = max((t for t, _ in waiting), default=0)
        for total, runs in waiting:
            told = 2 * total + (total == best)
            for run in runs:
                out[run].append(told)

    for key, total, runs in merged(bodies):
        if key // n_b != side:
            give_back()
            side, waiting = key // n_b, []
        waiting.append((total, runs))
    give_back()
    return [_squeezed(np.asarray(x, np.int64)) for x in out]


# Blocks


def _block_fields(id_type: pa.DataType) -> pa.Schema:
    lists = [pa.field("ids", pa.list_(id_type)), *(pa.field(c, pa.list_(pa.int64())) for c in _COUNTS), pa.field("groups", pa.list_(pa.string()))]
    runs = [pa.field("pairs", pa.list_(pa.binary())), pa.field("records", pa.list_(pa.binary()))]
    return pa.schema([pa.field("block", pa.int64()), *lists, *runs])


class _Block:
    """Texts taken in until the block is full."""

    def __init__(self) -> None:
        self.n = self.size = 0
        self.ids: list = []
        self.counts: dict[str, list] = {c: [] for c in _COUNTS}
        self.groups: list[str] = []
        self.links: list[np.ndarray] = []

    def take(self, own: Aligner, ids: list, texts: list[str | None], with_groups: bool) -> None:
        counts, groups, pairs, rows = own.align(texts)
        for c in _COUNTS:
            self.counts[c].append(counts[c])
        self.groups += groups if with_groups else [g and hashlib.sha256(g.encode()).hexdigest() for g in groups]
        # one sorted number: radix, pair, document
        numbers = (pairs // own.n_b % RADIX << _PAIR_BITS | pairs) << _DOC_BITS | (rows + self.n)
        self.links.append(numbers)
        self.ids += ids
        self.n += len(ids)
        self.size += sum(len(t or "") for t in texts) + 64 * len(ids)

    def closed(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        found, times = np.unique(np.concatenate(self.links), return_counts=True)
        rows = found & (1 << _DOC_BITS) - 1
        keys = found >> _DOC_BITS
        bounds = np.searchsorted(keys >> _PAIR_BITS, np.arange(RADIX + 1))
        pairs, records = [], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            distinct, n_docs = np.unique(keys[a:b] & (1 << _PAIR_BITS) - 1, return_counts=True)
            pairs.append(write_run(distinct, n_docs) if b > a else None)
            records.append(_squeezed(rows[a:b], times[a:b]) if b > a else None)
        columns = [[number], [self.ids], *([np.concatenate(self.counts[c])] for c in _COUNTS), [self.groups], [pairs], [records]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _blocks(docs: DataFrame, byte_level: str, pieces: str, with_groups: bool) -> DataFrame:
    """Blocks with their runs, written once."""
    id_type = docs.schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_level, pieces)
        number = TaskContext.get().partitionId() << 20
        block = None
        for batch in piece_codec.slices(batches, 1):
            schema = _block_fields(batch.schema.field(0).type)
            block = block or _Block()
            block.take(own, batch.column(0).to_pylist(), batch.column(1).to_pylist(), with_groups)
            if block.size >= BLOCK_BYTES:
                yield block.closed(number, schema)
                number, block = number + 1, None
        if block:
            yield block.closed(number, schema)

    schema = ", ".join(
        ["block bigint", f"ids array<{id_type.simpleString()}>", *(f"{c} array<bigint>" for c in _COUNTS)]
        + ["groups array<string>", "pairs array<binary>", "records array<binary>"]
    )
    return materialize(docs.mapInArrow(run, schema), "link_blocks")


def _answers(runs: DataFrame, n_units: int, n_b: int, level: int = 0) -> DataFrame:
    """(radix, unit, told) for runs of (radix, unit, body)."""
    groups = -(-n_units // FAN_IN)
    told = pa.schema([("radix", pa.int32()), ("unit", pa.int64()), ("told", pa.binary())])

    def last(key: tuple, table: pa.Table) -> pa.Table:
        units = table.column("unit")
        answers = answer_runs(table.column("body").to_pylist(), n_b)
        return pa.table([pa.array([key[0].as_py()] * len(answers), pa.int32()), units, pa.array(answers, pa.binary())], schema=told)

    if groups == 1:
        return materialize(runs.groupBy("radix").applyInArrow(last, "radix int, unit bigint, told binary"), "link_totals")

    def together(key: tuple, table: pa.Table) -> pa.Table:
        row = [[key[0].as_py()], [key[1].as_py()], [merge_runs(table.column("body").to_pylist())]]
        kinds = pa.schema([("radix", pa.int32()), ("unit", pa.int64()), ("body", pa.binary())])
        return pa.table([pa.array(c, k) for c, k in zip(row, kinds.types, strict=True)], schema=kinds)

    def down(key: tuple, children: pa.Table, parent: pa.Table) -> pa.Table:
        keys, _ = whole_run(parent.column("body")[0].as_py())
        (totals,), _ = _opened(parent.column("told")[0].as_py(), 1)
        own = [whole_run(b)[0] for b in children.column("body").to_pylist()]
        answers = [_squeezed(totals[np.searchsorted(keys, k)]) for k in own]
        return pa.table([children.column("radix"), children.column("unit"), pa.array(answers, pa.binary())], schema=told)

    dealt = runs.withColumn("team", F.pmod(F.xxhash64("unit", F.lit(level)), F.lit(groups)))
    parents = materialize(dealt.groupBy("radix", "team").applyInArrow(together, "radix int, unit bigint, body binary"), "link_runs")
    known = _answers(parents, groups, n_b, level + 1)
    above = parents.join(known, ["radix", "unit"]).withColumnRenamed("unit", "team")
    by = ("radix", "team")
    return materialize(
        dealt.groupBy(*by).cogroup(above.groupBy(*by)).applyInArrow(down, "radix int, unit bigint, told binary"), "link_totals"
    )


def token_links(
    docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = True
) -> DataFrame:
    """One row per document: the id column, n_a, n_b, n_groups, n_links, n_best, count_sum and the groups.

    ``groups`` is written ``a1,a2|b1;a3|b2,b3``; with ``with_groups`` false the column is ``groups_sha256`` in its
    place, so that the long text need not be stored.
    """
    package_on_workers(docs.sparkSession)
    pairs = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    id_type = pairs.schema[0].dataType.simpleString()
    blocks = _blocks(pairs, byte_level, pieces, with_groups)
    n_blocks = blocks.select("block").count()
    runs = blocks.select(F.col("block").alias("unit"), F.posexplode("pairs").alias("radix", "body"))
    runs = runs.where(F.col("body").isNotNull()).select("radix", "unit", "body")
    told = _answers(runs, max(1, n_blocks), _n_pieces(pieces))
    replies = told.groupBy(F.col("unit").alias("block")).agg(F.collect_list(F.struct("radix", "told")).alias("told"))

    names = [id_col, *_COUNTS, "n_best", "count_sum", "groups" if with_groups else "groups_sha256"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(batch.schema.get_field_index(c))[i] for c in batch.schema.names}
                n = len(row["ids"])
                best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
                answers = {x["radix"]: x["told"] for x in row["told"].as_py() or ()}
                runs = zip(row["pairs"].as_py(), row["records"].as_py(), strict=True)
                for radix, (pairs, records) in enumerate(runs):
                    if pairs is None:
                        continue
                    (told,), _ = _opened(answers[radix], 1)
                    (places, times), _ = _opened(records, 2)
                    told = np.repeat(told, whole_run(pairs)[1])
                    np.add.at(total, places, (told >> 1) * times)
                    np.add.at(best, places, (told & 1) * times)
                columns = [row["ids"].values, *(row[c].values for c in _COUNTS), pa.array(best), pa.array(total), row["groups"].values]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join([f"`{id_col}` {id_type}", *(f"{c} bigint" for c in names[1:-1]), f"{names[-1]} string"])
    return blocks.join(replies, "block", "left").mapInArrow(summed, schema)


def _n_pieces(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
