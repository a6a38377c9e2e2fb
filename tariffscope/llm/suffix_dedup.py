"""Repeated byte strings, found by sorting suffixes with hash comparisons.

A sorted array of all suffixes of a corpus is many times its size. Here only suffixes at anchors are
sorted: of the 20-byte strings in every 50-byte window the one with the smallest hash marks an anchor
(the leftmost on a tie), so equal windows have an anchor at the same offset. An anchor whose 20 bytes
occur nowhere else cannot lie in a repeat; one exchange of anchor keys between blocks (a Spark shuffle)
leaves the others. These are sent with the 30 bytes before them and the 50 bytes from them on, once for
each distinct context and block, and meet in buckets by their key.

In a bucket the suffixes at the anchors are sorted by a merge sort. Two are compared by binary search for
their longest common extension over prefix polynomial hashes, then by one byte. The common extensions of
neighbours in that order, with the hashes of the bytes to the left, tell which windows are equal; the
bytes of every reported window are compared with those of its first occurrence, so a hash collision can
neither make nor hide a repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tariffscope.llm import blocks as B
from tariffscope.llm.hashing import _BYTE, join_texts, mix
from tariffscope.llm.substring_dedup import runs_of
from tariffscope.session import materialize

U = np.uint64
_FACTOR = U(0xD1342543DE82EF95)
_CHUNK = 1 << 20
_PLACE = U((1 << 22) - 1)

REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, removed_spans array<bigint>, kept_sha256 string"


def gram_names(buf: np.ndarray, k: int) -> np.ndarray:
    """The name of every string of k bytes, built by doubling."""
    done, length = np.zeros(len(buf) + 1, U), 0
    part, size, rest = _BYTE[buf], 1, k
    while rest:
        step = U(pow(int(_FACTOR), size, 2**64))
        if rest & 1:
            room = max(0, len(buf) - length - size + 1)
            done = done[:room] * step + part[length : length + room]
            length += size
        rest >>= 1
        if rest:
            part = part[:-size] * step + part[size:]
            size *= 2
    return mix(done)


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


class Shape:
    """Lengths: a repeat, the string that makes an anchor, and what may lie before and after an anchor."""

    def __init__(self, length: int):
        self.length = length
        self.gram = max(1, 2 * length // 5)
        self.left = length - self.gram
        self.width = self.left + length
        self.masks = -(-(self.left + 1) // 8)


class _Anchors:
    """Where the anchors of a block are, and their keys."""

    def __init__(self, block: B.Block, shape: Shape):
        self.shape = shape
        self.buf, self.offsets = join_texts(block.texts)
        begin, end = self.offsets[:-1], self.offsets[1:] - 1
        step = np.zeros(len(self.buf) + 1, np.int32)
        fits = end - begin >= shape.length
        np.add.at(step, begin[fits], 1)
        np.add.at(step, end[fits] - shape.length + 1, -1)
        whole = np.cumsum(step) > 0
        places, keys = [], []
        for at in range(0, max(0, len(self.buf) - shape.length + 1), _CHUNK):
            starts = min(_CHUNK, len(self.buf) - shape.length + 1 - at)
            names = gram_names(self.buf[at : at + starts + shape.length - 1], shape.gram)
            least = _sliding_min((names & ~_PLACE) | np.arange(len(names), dtype=U), shape.left + 1)
            chosen = np.unique((least[whole[at : at + starts]] & _PLACE).astype(np.int64))
            places.append(chosen + at)
            keys.append(mix(names[chosen] + U(1)))  # anchors have small names; their keys must spread
        places = np.concatenate(places) if places else np.zeros(0, np.int64)
        self.at, first = np.unique(places, return_index=True)
        self.keys = np.concatenate(keys)[first] if keys else np.zeros(0, U)
        self.doc = np.searchsorted(self.offsets, self.at, "right") - 1

    def room(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many bytes before an anchor and from it on belong to its text, up to what can matter."""
        at, doc = self.at[rows], self.doc[rows]
        return (
            np.minimum(self.shape.left, at - self.offsets[doc]).astype(np.uint8),
            np.minimum(self.shape.length, self.offsets[doc + 1] - 1 - at).astype(np.uint8),
        )

    def contexts(self, rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        s = self.shape
        padded = np.concatenate([np.zeros(s.left, np.uint8), self.buf, np.zeros(s.length, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, s.width)[self.at[rows]]
        column = np.arange(s.width, dtype=np.int16)
        outside = (column < (s.left - left.astype(np.int16))[:, None]) | (column >= (s.left + right.astype(np.int16))[:, None])
        return np.where(outside, np.uint8(0), view)


def _row_names(rows: np.ndarray) -> np.ndarray:
    """One name for each row of bytes."""
    pad = -rows.shape[1] % 8
    wide = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad)))).view(U)
    total = np.zeros(len(rows), U)
    for i in range(wide.shape[1]):
        total = mix(total * _FACTOR + wide[:, i] + U(i + 1))
    return total


class _Contexts:
    """The distinct contexts of a block's shared anchors; the smallest document speaks for each."""

    def __init__(self, anchors: _Anchors, shared: np.ndarray, bits: int, ids: np.ndarray):
        self.anchors = anchors
        self.rows = np.flatnonzero(shared)
        self.left, self.right = anchors.room(self.rows)
        self.text = anchors.contexts(self.rows, self.left, self.right)
        names = _row_names(np.concatenate([self.text, self.left[:, None], self.right[:, None]], 1))
        own, keys = ids[anchors.doc[self.rows]], anchors.keys[self.rows]
        order = np.lexsort((self.rows, own, names, keys))
        new = np.ones(len(order), bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (names[order][1:] != names[order][:-1])
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.first = order[new]
        self.later = own > own[self.first][self.group]
        self.own = own
        self.bounds = np.searchsorted(keys[self.first] >> U(64 - bits), np.arange((1 << bits) + 1, dtype=U))

    def questions(self) -> Iterator[tuple[int, list[bytes]]]:
        for bucket in np.flatnonzero(np.diff(self.bounds)).tolist():
            rows = self.first[self.bounds[bucket] : self.bounds[bucket + 1]]
            yield bucket, [x[rows].tobytes() for x in (self.text, self.left, self.right, self.own)]

    def repeated_starts(self, answers: dict[int, bytes]) -> np.ndarray:
        """Starts, in the joined text, of all windows that also start in a smaller document."""
        s = self.anchors.shape
        masks = np.zeros((len(self.first), s.masks), np.uint8)
        for bucket, body in answers.items():
            masks[self.bounds[bucket] : self.bounds[bucket + 1]] = np.frombuffer(body, np.uint8).reshape(-1, s.masks)
        at, starts = self.anchors.at[self.rows], []
        mine = masks[self.group]
        for j in range(s.left + 1):
            hit = (mine[:, j >> 3] >> (j & 7) & 1).astype(bool) | self.later
            hit &= (self.left >= j) & (self.right >= s.length - j)
            starts.append(at[hit] - j)
        return np.concatenate(starts)


# In a bucket


def _prefix_hashes(text: np.ndarray) -> np.ndarray:
    """Column i names the first i symbols of each row. Symbols are byte + 1, or 0 past the end of a text."""
    out = np.zeros((len(text), text.shape[1] + 1), U)
    for i in range(text.shape[1]):
        out[:, i + 1] = (out[:, i] + _BYTE[text[:, i] & 255] + (text[:, i] >> 8).astype(U)) * _FACTOR
    return out


def _common(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common extension of rows a and b, by binary search."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), prefix.shape[1] - 1)
    while np.any(low < high):
        middle = (low + high + 1) >> 1
        same = prefix[a, middle] == prefix[b, middle]
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def sort_suffixes(symbols: np.ndarray, prefix: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the rows by group, then by symbols: a bottom-up merge sort with hash comparisons."""
    order = np.argsort(group, kind="stable")
    ranked = group[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(order) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(first, len(order)))
    start, size = np.repeat(first, lengths), np.repeat(lengths, lengths)
    last = symbols.shape[1] - 1

    def below(a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        n = _common(prefix, a, b)
        at = np.minimum(n, last)
        return np.where(n > last, ties, symbols[a, at] < symbols[b, at])

    width = 1
    while len(lengths) and width < lengths.max():
        place = np.flatnonzero(size > width)
        local = place - start[place]
        run = local // width
        low = np.minimum((run ^ 1) * width, size[place])
        begin, high = low.copy(), np.minimum(low + width, size[place])
        ties = (run & 1).astype(bool)  # the right run's rows come after equal rows of the left
        me = order[place]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            less = below(order[start[place[open_]] + middle], me[open_], ties[open_])
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
        target = start[place] + (run >> 1) * 2 * width + (local - run * width) + (low - begin)
        order[target] = me
        width *= 2
    return order


def _earlier(shape: Shape):
    """Answers of a bucket: per context a bit for each offset, set if that window starts in a smaller document."""
    s = shape

    def answer(numbers: list[int], rows: list[list[bytes]]) -> list[bytes]:
        text = np.concatenate([np.frombuffer(r[0], np.uint8) for r in rows]).reshape(-1, s.width)
        left, right = (np.concatenate([np.frombuffer(r[i], np.uint8) for r in rows]) for i in (1, 2))
        ids = np.concatenate([np.frombuffer(r[3], np.int64) for r in rows])
        column = np.arange(s.length)
        inside = column < right[:, None]
        after = np.where(inside, text[:, s.left :].astype(np.int16) + 1, 0)
        prefix = _prefix_hashes(after)
        order = sort_suffixes(after, prefix, prefix[:, s.gram])
        common = np.zeros(len(order), np.int64)
        if len(order) > 1:
            common[1:] = _common(prefix, order[1:], order[:-1])
        del prefix, after
        before = _prefix_hashes(text[:, : s.left][:, ::-1].astype(np.int16) + 1)[order]
        text, left, right, ids_ = text[order], left[order], right[order], ids[order]
        masks = np.zeros((len(order), s.masks), np.uint8)
        for j in range(s.left + 1):
            ok = np.flatnonzero((left >= j) & (right >= s.length - j))
            if len(ok) < 2:
                continue
            run = np.cumsum(common < s.length - j)[ok]
            name = mix(run.astype(U) * _FACTOR + before[ok, j])
            hits = _above_least(name, ids_[ok])
            later = np.flatnonzero(hits >= 0)
            if len(later):
                a, b = ok[later], ok[hits[later]]
                cut = slice(s.left - j, s.left - j + s.length)
                if not np.array_equal(text[a, cut], text[b, cut]):  # a collision: group by the bytes themselves
                    exact = np.unique(np.ascontiguousarray(text[ok, cut]), axis=0, return_inverse=True)[1]
                    a = ok[_above_least(exact.ravel(), ids_[ok]) >= 0]
                masks[a, j >> 3] |= np.uint8(1 << (j & 7))
        back = np.empty_like(masks)
        back[order] = masks
        sizes = np.cumsum([len(r[1]) for r in rows])[:-1]
        return [m.tobytes() for m in np.split(back, sizes)]

    return answer


def _above_least(name: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row a row with the same name and the least id, or -1 where the id is the least itself."""
    order = np.argsort(name, kind="stable")
    ranked = name[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    lengths = np.diff(np.append(first, len(order)))
    least = np.repeat(np.minimum.reduceat(ids[order], first), lengths)
    holds = np.where(ids[order] == least, np.arange(len(order)), len(order))
    speaker = np.repeat(np.minimum.reduceat(holds, first), lengths)
    out = np.empty(len(order), np.int64)
    out[order] = np.where(ids[order] == least, -1, order[speaker])
    return out


def drop_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """Per document the bytes covered by a string of ``length`` bytes that also starts in a smaller document.

    Texts are taken as UTF-8; matches never cross documents; strings are judged on the input. ``length``
    is from 5 to 250. Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), removed_spans
    (their starts and ends, alternating) and kept_sha256 (hex, of the bytes that stay).

    A null text is empty, and texts shorter than ``length`` keep everything. A null id is smaller than all
    others. Rows with equal ids never remove each other's bytes. Empty tables give empty results; other
    columns are ignored.
    """
    if not 5 <= length <= 250:
        raise ValueError("length must be from 5 to 250")
    shape = Shape(length)
    packed = B.pack(docs, id_col, text_col)
    size = B.text_bytes(packed)
    key_bits, context_bits = B.bucket_bits(size // 4), B.bucket_bits(size, 6 << 20)

    def ask_keys(block: B.Block) -> Iterator[tuple[int, list[bytes]]]:
        return B.Keys.of(_Anchors(block, shape).keys, key_bits).questions(key_bits)

    def found(block: B.Block, answers: dict[int, bytes]) -> _Contexts:
        anchors = _Anchors(block, shape)
        return _Contexts(anchors, B.Keys.of(anchors.keys, key_bits).shared(answers), context_bits, block.ids)

    def ask_contexts(block: B.Block) -> Iterator[tuple[int, list[bytes]]]:
        return found(block, block.answers).questions()

    known = B.with_answers(packed, B.ask(packed, ask_keys, B.seen_twice, 1, "anchors"))
    later = B.ask(known, ask_contexts, _earlier(shape), 4, "contexts")
    final = known.withColumnRenamed("answers", "key_answers").join(
        B.with_answers(packed, later).select("block", "answers"), "block", "left"
    )

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys in zip(B.opened(iter([batch])), batch.column(batch.schema.names.index("key_answers")), strict=True):
                contexts = found(block, {a["bucket"]: a["body"] for a in keys.as_py() or []})
                anchors = contexts.anchors
                step = np.zeros(len(anchors.buf) + 1, np.int32)
                starts = contexts.repeated_starts(block.answers)
                np.add.at(step, starts, 1)
                np.add.at(step, starts + length, -1)
                yield _digest(block, anchors.offsets, np.cumsum(step[:-1]) > 0)

    return materialize(final.mapInArrow(result, REMOVED), "suffix_dedup")


def _digest(block: B.Block, offsets: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
    removed, spans, hashes = [], [], []
    for d, text in enumerate(block.texts):
        starts, ends = runs_of(gone[offsets[d] : offsets[d + 1] - 1])
        edges = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(text)]
        removed.append(int((ends - starts).sum()))
        spans.append(edges[1:-1])
        hashes.append(hashlib.sha256(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))).hexdigest())
    columns = [block.id_column(), pa.array([len(t) for t in block.texts], pa.int64()), pa.array(removed, pa.int64()), pa.array([len(s) // 2 for s in spans], pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(hashes)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "removed_spans", "kept_sha256"])
