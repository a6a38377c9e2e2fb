"""Repeated word windows, found by recompression.

Every text is rewritten in rounds. In a round each symbol falls into one of two classes, by a bit of its
name, and two neighbours of which the first is of class 0 and the second of class 1 become one symbol. A
new symbol's name is a hash of the names of its parts, so naming is global without an exchange: equal
substrings get equal symbols, but for a margin at both ends. A run of one token never pairs with itself;
its positions keep the token's name and count as one key.

After the rounds a symbol spans at most 2^ROUNDS words, and a round spoils at most one symbol at each end
of a substring: 1 + 2 + 4 = 7 words for three rounds. So in two equal windows of 20 words the same symbols
cover words 7 to 12, and a window can only repeat if each symbol there occurs twice in the corpus. That is
one exchange of symbol names between blocks (a Spark shuffle). The windows that are left are verified in a
second exchange, by two independent names each, against all others; the earliest occurrence stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tariffscope.llm import blocks as B
from tariffscope.llm.hashing import join_texts, mix, window_names, word_names, word_spans
from tariffscope.session import materialize

ROUNDS = 3
U = np.uint64

REMOVED = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, removed_spans array<bigint>, kept_sha256 string"


def symbols(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The symbols after the rounds, and for every word the place of its symbol."""
    place = np.arange(len(names))
    for r in range(rounds):
        bit = (mix(names + U(r + 1)) & U(1)).astype(bool)
        second = np.zeros(len(names), bool)
        second[1:] = ~bit[:-1] & bit[1:] & (doc[1:] == doc[:-1])
        first = np.flatnonzero(~second)
        merged = np.zeros(len(names), bool)
        merged[:-1] = second[1:]
        pair = mix(names[:-1] * U(0xD6E8FEB86659FD93) + names[1:] + U(r)) if len(names) else names
        names = np.append(np.where(merged[:-1], pair, names[:-1]), names[-1:])[first]
        doc = doc[first]
        place = (np.cumsum(~second) - 1)[place]
    return names, place


class _Words:
    """The words of a block and what recompression makes of them."""

    def __init__(self, block: B.Block, window: int, rounds: int):
        self.window, margin = window, 2**rounds - 1
        self.buf, offsets = join_texts(block.texts)
        self.starts, self.ends = word_spans(self.buf)
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.first_word = np.searchsorted(self.doc, np.arange(len(block.texts) + 1))
        self.names = word_names(self.buf, self.starts, self.ends)
        self.symbols, self.place = symbols(self.names, self.doc, rounds)
        self.core = (margin, window - margin)

    def whole_windows(self) -> np.ndarray:
        n = len(self.names) - self.window + 1
        return self.doc[:n] == self.doc[self.window - 1 :] if n > 0 else np.zeros(0, bool)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of windows all of whose inner symbols are shared."""
        whole = self.whole_windows()
        if not len(whole):
            return np.zeros(0, np.int64)
        counts = np.concatenate([[0], np.cumsum(shared[self.place])])
        a, b = self.core
        n = len(whole)
        return np.flatnonzero(whole & (counts[b : b + n] - counts[a : a + n] == b - a))

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(window_names(self.names, self.window, seed)[at] for seed in (1, 2))


class _Windows:
    """The distinct candidate windows of a block, each with its first place in the block."""

    def __init__(self, words: _Words, shared: np.ndarray, bits: int, ids: np.ndarray):
        self.at = words.candidates(shared)
        high, low = words.windows(self.at)
        order = np.lexsort((self.at, low, high))
        high, low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.high, self.low, first = high[new], low[new], self.at[order][new]
        self.first = first
        self.ids, self.position = ids[words.doc[first]], (first - words.first_word[words.doc[first]]).astype(np.int32)
        self.bounds = np.searchsorted(self.high >> U(64 - bits), np.arange((1 << bits) + 1, dtype=U))

    def questions(self) -> Iterator[tuple[int, list[bytes]]]:
        for bucket in np.flatnonzero(np.diff(self.bounds)).tolist():
            part = slice(self.bounds[bucket], self.bounds[bucket + 1])
            yield bucket, [x[part].tobytes() for x in (self.high, self.low, self.ids, self.position)]

    def repeats(self, answers: dict[int, bytes]) -> np.ndarray:
        """Starts of all windows that also start earlier."""
        later = np.zeros(len(self.high), bool)
        for bucket, body in answers.items():
            a, b = self.bounds[bucket], self.bounds[bucket + 1]
            later[a:b] = np.unpackbits(np.frombuffer(body, np.uint8), count=b - a).astype(bool)
        return self.at[later[self.group] | (self.at != self.first[self.group])]


def _not_first(numbers: list[int], rows: list[list[bytes]]) -> list[bytes]:
    """For each block's windows in a bucket a bit: does the window start earlier in another block?"""
    cols = [np.concatenate([np.frombuffer(r[i], kind) for r in rows]) for i, kind in enumerate((U, U, np.int64, np.int32))]
    sizes = [len(r[0]) // 8 for r in rows]
    block = np.repeat(np.array(numbers, np.int64), sizes)
    high, low, ids, position = cols
    order = np.lexsort((position, block, ids, low, high))
    later = np.zeros(len(order), bool)
    later[1:] = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    flags = np.empty(len(order), bool)
    flags[order] = later
    return [np.packbits(f).tobytes() for f in np.split(flags, np.cumsum(sizes)[:-1])]


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n places lie in [start, start + length) of some start."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:-1]) > 0


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of true places."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Per document the words that belong to a window of ``window`` words which also starts earlier.

    Words are runs of anything but blanks and code points 9 to 13, compared as they are. Earlier means: in
    a document with a smaller id, or in the same document at a smaller place. Windows are judged on the
    input. Returns doc_id, n_words, n_removed, n_spans (removed runs), removed_spans (their first word and
    the word after their last, alternating) and kept_sha256 (hex; kept words joined by a blank, UTF-8).

    Null and empty texts have no words; the hash is that of the empty string. A null id sorts before all
    others. Rows with equal ids are separate documents, in the order they are read. Empty tables give
    empty results; other columns are ignored.
    """
    rounds = ROUNDS
    while 2 * (2**rounds - 1) >= window and rounds:
        rounds -= 1
    packed = B.pack(docs, id_col, text_col)
    size = B.text_bytes(packed)
    key_bits, window_bits = B.bucket_bits(size // 4), B.bucket_bits(size)

    def ask_symbols(block: B.Block) -> Iterator[tuple[int, list[bytes]]]:
        return B.Keys.of(_Words(block, window, rounds).symbols, key_bits).questions(key_bits)

    def ask_windows(block: B.Block) -> Iterator[tuple[int, list[bytes]]]:
        words = _Words(block, window, rounds)
        shared = B.Keys.of(words.symbols, key_bits).shared(block.answers)
        return _Windows(words, shared, window_bits, block.ids).questions()

    replies = B.ask(packed, ask_symbols, B.seen_twice, 1, "symbols")
    known = B.with_answers(packed, replies)
    later = B.ask(known, ask_windows, _not_first, 4, "windows")
    final = known.withColumnRenamed("answers", "symbol_answers").join(
        B.with_answers(packed, later).select("block", "answers"), "block", "left"
    )

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, marks in zip(B.opened(iter([batch])), batch.column(batch.schema.names.index("symbol_answers")), strict=True):
                words = _Words(block, window, rounds)
                answers = {a["bucket"]: a["body"] for a in marks.as_py() or []}
                shared = B.Keys.of(words.symbols, key_bits).shared(answers)
                found = _Windows(words, shared, window_bits, block.ids)
                gone = covered(len(words.names), found.repeats(block.answers), window)
                yield _digest(block, words, gone)

    return materialize(final.mapInArrow(result, REMOVED), "substring_dedup")


def _digest(block: B.Block, words: _Words, gone: np.ndarray) -> pa.RecordBatch:
    n = np.diff(words.first_word)
    removed, spans, hashes = [], [], []
    for d, text in enumerate(block.texts):
        part = gone[words.first_word[d] : words.first_word[d + 1]]
        tokens = text.split()
        starts, ends = runs_of(part)
        if len(starts):
            tokens = [t for t, g in zip(tokens, part.tolist(), strict=True) if not g]
        removed.append(int(part.sum()))
        spans.append(np.stack([starts, ends], 1).ravel().tolist())
        hashes.append(hashlib.sha256(b" ".join(tokens)).hexdigest())
    columns = [block.id_column(), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(s) // 2 for s in spans], pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(hashes)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "n_spans", "removed_spans", "kept_sha256"])
