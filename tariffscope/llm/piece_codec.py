"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is split where no merge can reach across (before a space mark that follows another sign), and each
distinct chunk is merged once by the score-ordered agenda: all adjacent symbol pairs that form a piece wait
in a heap, best score first and leftmost first among equals; a merge retires the pairs it touches and adds
the two new ones. What the agenda gives for a chunk is checked against the sentencepiece library, in the Arrow
batch that brings it first; what the ids read as is checked for every text.

Defined results: a null or empty text has no pieces, only the end id where one is asked for, and decodes to
the empty string; U+2581 in a text is a space to the vocabulary and decodes to one; signs without a piece become bytes
of their UTF-8 form; special tokens' names inside a text are plain text. Rows are kept as they are, null and repeated
ids included, and further columns of the input do not matter. Long texts are taken whole: one chunk of n signs
costs n log n.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.session import package_on_workers

MARK = "▁"
#: A merge never joins a space mark to a sign before it.
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Chunks a Python worker remembers twice at most: those met lately, and those met before them.
CACHED_CHUNKS = 400_000
#: Signs of a chunk that is merged side by side with others.
SHORT = 32
#: Place of a pair that forms no piece: after all others.
NO_PIECE = 1 << 40
#: Texts given to Python at once, by size.
SLICE_CHARS = 1 << 20


def _varint(body: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (body[at] & 127) << shift
        at += 1
        if body[at - 1] < 128:
            return value, at
        shift += 7


def _fields(body: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of a protocol buffer message; four-byte values as bytes."""
    at = 0
    while at < len(body):
        tag, at = _varint(body, at)
        if tag & 7 == 0:
            value, at = _varint(body, at)
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            if size is None:
                size, at = _varint(body, at)
            value, at = body[at : at + size], at + size
        yield tag >> 3, value


class Memory:
    """Ids of chunks met before, so that a chunk is encoded once; holds CACHED_CHUNKS twice and some at most."""

    def __init__(self, encode: Callable[[list[str]], list[tuple[int, ...]]]):
        self._encode = encode
        self._recent: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def all(self, chunks: Iterable[str]) -> dict[str, tuple[int, ...]]:
        known = dict.fromkeys(chunks)
        recent, older = self._recent, self._older
        new = []
        for chunk in known:
            ids = recent.get(chunk)
            if ids is None:
                ids = older.get(chunk)
                if ids is None:
                    new.append(chunk)
                    continue
                recent[chunk] = ids
            known[chunk] = ids
        for chunk, ids in zip(new, self._encode(new), strict=True):
            known[chunk] = ids
            if len(chunk) <= SHORT:
                recent[chunk] = ids
        if len(recent) > CACHED_CHUNKS:
            # what was not met since the last change goes
            self._recent, self._older = {}, recent
        return known


class Codec:
    """Encoder and decoder over one vocabulary file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        self.pieces = [sp.id_to_piece(i) for i in ids]
        unknown = self._accept(sp.serialized_model_proto())
        special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        scores = {i: sp.get_score(i) for i in ids if i not in special}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Piece -> place of its score; equal scores share a place.
        self.rank = {self.pieces[i]: order[s] for i, s in scores.items()}
        self.id = {self.pieces[i]: i for i in scores}
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in ids if sp.is_byte(i)}
        self.end = sp.eos_id()
        plain = [p.replace(MARK, " ").encode() for p in self.pieces]
        for i in special:
            plain[i] = bytes([int(self.pieces[i][3:5], 16)]) if sp.is_byte(i) else unknown if sp.is_unknown(i) else b""
        #: What each id stands for, in bytes; nothing for control ids.
        self.token_bytes = plain
        self.control = frozenset(i for i in ids if sp.is_control(i))
        #: Ids whose first space is text and no mark.
        self._literal = special
        self.memory = Memory(self.checked)
        self.unlike: set[str] = set()
        self._pairs()

    def _accept(self, model: bytes) -> bytes:
        """What an unknown id reads as. Raises for models that this codec would encode otherwise than the library."""
        trainer = dict(_fields(b"".join(v for k, v in _fields(model) if k == 2)))
        norm = dict(_fields(b"".join(v for k, v in _fields(model) if k == 3)))
        sp = self.library
        same = norm.get(2, b"") == b"" and norm.get(3, 1) == 1 and norm.get(4, 1) == 0 and norm.get(5, 1) == 1
        kinds = [dict(_fields(v)).get(3, 1) for k, v in _fields(model) if k == 1]
        if trainer.get(3) != 2 or not same or {4, 5} & set(kinds) or any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces):
            raise ValueError("only merge-type vocabularies with identity normalisation, a leading space and no user-defined or unused pieces")
        if not sp.is_byte(sp.piece_to_id("<0x00>")):
            raise ValueError("only vocabularies with byte pieces")
        return trainer.get(44, " \u2047 ".encode())

    def checked(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """Ids of chunks by the agenda; those for which the library gives others are kept in ``unlike``."""
        ids = self.merge(chunks)
        # the library puts the first space mark itself
        theirs = self.library.encode([c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
        self.unlike.update(c for c, a, b in zip(chunks, ids, theirs, strict=True) if a != tuple(b) and c != MARK)
        return ids

    def merge(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """Ids of chunks by the agenda: many short ones side by side, a long one with a heap."""
        if all(len(c) <= SHORT for c in chunks):
            return self._side_by_side(chunks)
        short = iter(self._side_by_side([c for c in chunks if len(c) <= SHORT]))
        return [next(short) if len(c) <= SHORT else self._ids(self._by_heap(c)) for c in chunks]

    def _pairs(self) -> None:
        """Hash table from two adjacent symbols to the place of the pair; symbols are signs or pieces as numbers."""
        self._sign = np.arange(0x110000, dtype=np.int64) + len(self.pieces)
        for piece, number in self.id.items():
            if len(piece) == 1:
                self._sign[ord(piece)] = number
        code = lambda x: int(self._sign[ord(x)]) if len(x) == 1 else self.id.get(x)
        found = {}
        for piece, number in self.id.items():
            for cut in range(1, len(piece)):
                left, right = code(piece[:cut]), code(piece[cut:])
                if left is not None and right is not None:
                    found[left << 22 | right] = (self.rank[piece], number)
        self._bits = max(4, (4 * len(found)).bit_length())
        self._keys = np.full((1 << self._bits) + 64, -1, np.int64)
        self._place = np.full(len(self._keys), NO_PIECE, np.int64)
        self._joined = np.zeros(len(self._keys), np.int64)
        keys = np.array(list(found), np.int64)
        slots = self._slot(keys)
        for key, slot, (place, number) in zip(keys.tolist(), slots.tolist(), found.values(), strict=True):
            while self._keys[slot] >= 0:
                slot += 1
            self._keys[slot], self._place[slot], self._joined[slot] = key, place, number

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each pair, and the slot that has it."""
        keys = left << 22 | right
        slots = self._slot(keys)
        seen = self._keys[slots]
        far = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(far):
            slots[far] += 1
            seen = self._keys[slots[far]]
            far = far[(seen != keys[far]) & (seen >= 0)]
        return np.where(self._keys[slots] == keys, self._place[slots], NO_PIECE), slots

    def _side_by_side(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """One round takes the best pair, leftmost among equals, from the agenda of every chunk that has one."""
        if not chunks:
            return []
        sizes = np.array([len(c) for c in chunks])
        symbols = self._sign[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)]
        owner = np.repeat(np.arange(len(chunks)), sizes)
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(sizes) - 1] = True
        done: list[tuple[np.ndarray, np.ndarray]] = []
        # the agenda: what each symbol forms with the next
        place = np.full(len(symbols), NO_PIECE)
        slot = np.zeros(len(symbols), np.int64)
        fresh = np.flatnonzero(~last)
        while len(symbols):
            place[fresh], slot[fresh] = self._found(symbols[fresh], symbols[fresh + 1])
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(place, starts)
            over = np.repeat(best == NO_PIECE, np.diff(np.r_[starts, len(symbols)]))
            if over.any():
                done.append((owner[over], symbols[over]))
                symbols, owner, last, place, slot = (x[~over] for x in (symbols, owner, last, place, slot))
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else starts[:0]
                best = best[best != NO_PIECE]
            if not len(symbols):
                break
            at = np.flatnonzero(place == np.repeat(best, np.diff(np.r_[starts, len(symbols)])))
            at = at[np.r_[True, owner[at[1:]] != owner[at[:-1]]]]
            symbols[at] = self._joined[slot[at]]
            last[at] = last[at + 1]
            place[at[last[at]]] = NO_PIECE
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, owner, last, place, slot = (x[stay] for x in (symbols, owner, last, place, slot))
            at -= np.arange(len(at))
            prior = at[(at > 0) & ~last[at - 1]] - 1
            fresh = np.concatenate([at[~last[at]], prior])
        if not done:
            return [()] * len(chunks)
        owners, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owners, kind="stable")
        owners, ids = owners[order], ids[order]
        if (odd := np.flatnonzero(ids >= len(self.pieces))).size:
            spelled = [[self.byte_id[x] for x in chr(i - len(self.pieces)).encode()] for i in ids[odd].tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[odd] = [len(x) for x in spelled]
            owners, ids = np.repeat(owners, counts), np.repeat(ids, counts)
            ids[ids >= len(self.pieces)] = list(chain.from_iterable(spelled))
        ends = np.cumsum(np.bincount(owners, minlength=len(chunks))).tolist()
        flat = ids.tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def _by_heap(self, chunk: str) -> list[str]:
        rank = self.rank
        parts = list(chunk)
        n = len(parts)
        agenda = []
        for i in range(n - 1):
            place = rank.get(parts[i] + parts[i + 1])
            if place is not None:
                agenda.append((place, i, i + 1, 2))
        heapq.heapify(agenda)
        if agenda:
            before, after = list(range(-1, n - 1)), [*range(1, n), -1]
            pop, push = heapq.heappop, heapq.heappush
            while agenda:
                _, left, right, size = pop(agenda)
                a, b = parts[left], parts[right]
                # a pair is out of date once either side was merged away or has grown
                if not a or not b or len(a) + len(b) != size:
                    continue
                parts[left], parts[right] = a + b, ""
                beyond = after[left] = after[right]
                if beyond >= 0:
                    before[beyond] = left
                    joined = a + b + parts[beyond]
                    place = rank.get(joined)
                    if place is not None:
                        push(agenda, (place, left, beyond, len(joined)))
                prior = before[left]
                if prior >= 0:
                    joined = parts[prior] + a + b
                    place = rank.get(joined)
                    if place is not None:
                        push(agenda, (place, prior, left, len(joined)))
        return list(filter(None, parts))

    def _ids(self, parts: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for part in parts:
            number = self.id.get(part)
            if number is None:
                out.extend(self.byte_id[x] for x in part.encode())
            else:
                out.append(number)
        return tuple(out)

    def cut(self, texts: list[str]) -> list[list[str]]:
        return [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]

    def encode(self, texts: list[str], cut: list[list[str]] | None = None) -> list[list[int]]:
        """Ids of each text; each distinct chunk of the texts is merged once and remembered for the next call."""
        cut = cut or self.cut(texts)
        get = self.memory.all(chain.from_iterable(cut)).__getitem__
        return [list(chain.from_iterable(map(get, c))) for c in cut]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, without the space put in front; a byte that ends no sign becomes U+FFFD."""
        upto = len(ids)
        while upto and ids[upto - 1] in self.control:
            upto -= 1
        ids = ids[:upto]
        # a control id has no text, but no sign reaches across it
        runs = [ids] if self.control.isdisjoint(ids) else [list(r) for c, r in groupby(ids, self.control.__contains__) if not c]
        bodies = [b"".join(map(self.token_bytes.__getitem__, r)) for r in runs]
        if bodies and bodies[0][:1] == b" " and runs[0][0] not in self._literal:
            bodies[0] = bodies[0][1:]
        try:
            return "".join(map(bytes.decode, bodies))
        except UnicodeDecodeError:
            return "".join(chain.from_iterable(map(_signs, bodies)))


def _signs(body: bytes) -> Iterator[str]:
    at = 0
    while at < len(body):
        for size in (1, 2, 3, 4):
            try:
                sign = body[at : at + size].decode()
            except UnicodeDecodeError:
                continue
            if len(sign) == 1:
                yield sign
                at += size
                break
        else:
            yield "�"
            at += 1


@functools.cache
def codec(path: str) -> Codec:
    """One codec a worker process and vocabulary."""
    return Codec(path)


def slices(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.RecordBatch]:
    """Cut batches so that Python holds about SLICE_CHARS of text at a time; a longer text comes alone."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > SLICE_CHARS:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: bool = True) -> DataFrame:
    """Every text as ids, and the ids as text again.

    Returns the id column, ``ids`` array<int>, ``decoded`` string and ``as_library`` boolean: whether the
    library gives the same ids for each chunk of the text and reads all ids as the same text. The rows stay where they are read; nothing is shuffled.
    """
    package_on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tail = [own.end] if end_id else []
            cut = own.cut(texts)
            ids = [x + tail for x in own.encode(texts, cut)]
            decoded = [own.decode(i) for i in ids]
            theirs = own.library.decode(ids, num_threads=1)
            same = [own.unlike.isdisjoint(c) and a == b for c, a, b in zip(cut, decoded, theirs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), pa.array(same, pa.bool_())], names
            )

    names = [id_col, "ids", "decoded", "as_library"]
    pairs = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    schema = f"`{id_col}` {pairs.schema[0].dataType.simpleString()}, ids array<int>, decoded string, as_library boolean"
    return pairs.mapInArrow(run, schema)
