"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Two strings of n characters that differ by e edits share at least n + 1 - q (e + 1) strings of q
characters, and these lie within e diagonals of each other. So a document region can hold a benchmark
passage only if (1) that many of its q-grams occur in the benchmark at all, and (2) that many lie in one
band of diagonals against one item. Bands overlap by the edit budget, so no match falls between two.
What is left is verified by alignment within the band, every window of the item against the region.

The benchmark is the query set: it is indexed in parts of bounded size, and each part is sent to the
tasks that read the documents. Documents are neither shuffled nor compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffscope.llm.hashing import join_texts
from tariffscope.llm.suffix_dedup import gram_names
from tariffscope.session import package_on_workers

Q = 10
WINDOW = 64
#: One edit for so many characters of a passage.
PER_EDIT = 16
#: Benchmark text that one index holds. A longer benchmark is searched for in several passes.
PART_BYTES = 2 << 20
_BITS = 22
_STRETCH = 2 << 20

LEAKS = "doc_id bigint, item_id bigint, start bigint, end bigint, item_start bigint, item_end bigint, item_length bigint, edits int"


def plain(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and every run of white space as one blank."""
    return b" ".join((text or "").encode().lower().split())


def bitmap_place(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - _BITS)).astype(np.int64)


class Index:
    """The q-grams of some benchmark items and where they stand."""

    def __init__(self, items: list[tuple[int, bytes]], q: int = Q, window: int = WINDOW, per_edit: int = PER_EDIT):
        self.q, self.ids = q, [i for i, _ in items]
        self.texts = [np.frombuffer(t, np.uint8) for _, t in items]
        self.window = np.array([min(window, len(t)) for _, t in items], np.int64)
        self.edits = np.array([max((e for e in range(int(w) // per_edit + 1) if w + 1 - q * (e + 1) >= 1), default=0) for w in self.window], np.int64)
        self.least = np.maximum(1, self.window + 1 - q * (self.edits + 1))
        grams = [gram_names(t, q) if len(t) >= q else np.empty(0, np.uint64) for t in self.texts]
        names = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(names, kind="stable")
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.names, self.first = np.unique(names[order], return_index=True)
        self.last = np.append(self.first[1:], len(names))
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[bitmap_place(self.names)] = True

    def leaks(self, texts: list[bytes]) -> Iterator[tuple]:
        """(text, item, start, end, item start, item end, edits) of every passage found."""
        if not len(self.names):
            return
        buf, offsets = join_texts(texts)
        if len(buf) < self.q:
            return
        names = gram_names(buf, self.q)
        hits = np.flatnonzero(self.bitmap[bitmap_place(names)])
        rank = np.minimum(np.searchsorted(self.names, names[hits]), len(self.names) - 1)
        real = self.names[rank] == names[hits]
        hits, rank = hits[real], rank[real]
        # (1) enough q-grams of the benchmark within the length of a passage
        least, reach = int(self.least.min()), int((self.window + self.edits).max()) - self.q
        near = np.searchsorted(hits, hits + reach, "right")
        enough = near - np.arange(len(hits)) >= least
        keep = np.zeros(len(hits) + 1, np.int64)
        np.add.at(keep, np.flatnonzero(enough), 1)
        np.add.at(keep, near[enough], -1)
        chosen = np.cumsum(keep[:-1]) > 0
        hits, rank = hits[chosen], rank[chosen]
        if not len(hits):
            return
        counts = self.last[rank] - self.first[rank]
        rows = np.repeat(self.first[rank] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        at, item, place = np.repeat(hits, counts), self.item[rows].astype(np.int64), self.place[rows].astype(np.int64)
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + self.q <= offsets[doc + 1] - 1
        at, item, place, doc = at[inside], item[inside], place[inside], doc[inside]
        # (2) enough of them in one band of diagonals; bands overlap by the edits allowed
        edits = self.edits[item]
        width = edits + 1
        diagonal = at - place + (1 << 40)
        band = diagonal // width
        also = (diagonal % width < edits)
        at, item, place, doc, band = (np.concatenate([x, y[also]]) for x, y in ((at, at), (item, item), (place, place), (doc, doc), (band, band - 1)))
        order = np.lexsort((at, band, item, doc))
        at, item, place, doc, band = at[order], item[order], place[order], doc[order], band[order]
        group = np.cumsum(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])])) - 1
        need, length = self.least[item], self.window[item] + self.edits[item] - self.q
        ahead = np.arange(len(at)) + need - 1
        ok = ahead < len(at)
        ahead = np.minimum(ahead, len(at) - 1)
        full = ok & (group[ahead] == group) & (at[ahead] - at <= length)
        found: dict[tuple[int, int], list] = {}
        for i in np.flatnonzero(full).tolist():
            found.setdefault((int(doc[i]), int(item[i])), []).append((int(place[i]), int(place[ahead[i]]), int(band[i])))
        for (d, n), seen in found.items():
            yield from ((d, n, *x) for x in self._aligned(buf[offsets[d] : offsets[d + 1] - 1], int(offsets[d]), n, seen))

    def _aligned(self, text: np.ndarray, base: int, n: int, seen: list[tuple[int, int, int]]) -> Iterator[tuple]:
        """Regions of one text that align with windows of one item, merged."""
        item, window, edits = self.texts[n], int(self.window[n]), int(self.edits[n])
        bands: dict[int, set[int]] = {}
        for first, last, band in seen:
            # windows of the item that can hold these q-grams
            begin = max(0, last + self.q - window)
            bands.setdefault(band, set()).update(range(begin, max(begin, min(first, len(item) - window)) + 1))
        good: list[tuple[int, int, int, int, int]] = []
        for band, starts_ in bands.items():
            starts = np.array(sorted(s for s in starts_ if s + window <= len(item)), np.int64)
            low = band * (edits + 1) - (1 << 40) - base - edits
            columns = 4 * edits + 2
            cost = np.zeros((len(starts), columns), np.int64)
            offset = np.arange(columns)
            for r in range(1, window + 1):
                symbol = item[starts + r - 1]
                j = starts[:, None] + r + low + offset  # characters of the text before the cell
                there = (j >= 1) & (j <= len(text))
                same = there & (text[np.clip(j - 1, 0, len(text) - 1)] == symbol[:, None])
                step = np.where(there, cost + ~same, window)
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                cost = np.minimum.accumulate(step - offset, axis=1) + offset
            ends = cost.argmin(axis=1)
            least = cost[np.arange(len(starts)), ends]
            for s, e, c in zip(starts.tolist(), ends.tolist(), least.tolist(), strict=True):
                if c <= edits:
                    stop = min(len(text), max(0, s + window + low + e))
                    good.append((max(0, stop - window), stop, s, s + window, c))
        good.sort()
        merged: list[list[int]] = []
        for g in good:
            if merged and g[0] <= merged[-1][1] and g[2] <= merged[-1][3]:
                m = merged[-1]
                m[1], m[2], m[3], m[4] = max(m[1], g[1]), min(m[2], g[2]), max(m[3], g[3]), max(m[4], g[4])
            else:
                merged.append(list(g))
        yield from (tuple(m) for m in merged)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each benchmark passage in a document.

    A passage is 64 characters (bytes of the normalised text; the whole item where it is shorter) of an
    item that a part of the document equals but for one edit in 16 characters. Both are normalised: A-Z
    lower-cased, white space as one blank. Returns doc_id, item_id, start and end in the normalised
    document, item_start, item_end, item_length and the edits of the worst window in the region.

    Null and empty texts match nothing, nor do items under 10 characters. Repeated items each match; rows
    with equal or null ids are searched one by one. An empty benchmark or table gives an empty result;
    other columns are ignored.
    """
    spark = docs.sparkSession
    package_on_workers(spark)
    items = benchmark.select(F.col(item_col).cast("bigint").alias("i"), F.col(item_text_col).alias("t")).where("t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    found = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part)
        index = spark.sparkContext.broadcast(Index([(r.i, plain(r.t)) for r in own.collect()]))
        rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_searcher(index), LEAKS)
        found = rows if found is None else found.union(rows)
    return found


def _searcher(index):
    def search(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        i = index.value
        rows = [(ids[d], i.ids[n], a, b, s, e, len(i.texts[n]), c) for d, n, a, b, s, e, c in i.leaks(texts)]
        kinds = pa.schema([*((c, pa.int64()) for c in "doc_id item_id start end item_start item_end item_length".split()), ("edits", pa.int32())])
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.types, strict=True)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list = []
            texts: list[bytes] = []
            size = 0
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(plain(t))
                size += len(texts[-1])
                if size > _STRETCH:
                    yield search(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield search(ids, texts)

    return run
