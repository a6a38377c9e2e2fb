"""Similarity join of documents on word shingles, by partitions of the shingle universe.

Two sets of sizes s >= t that share a fraction of at least J = 4/5 of their union differ in at most
(s + t) / 9 elements. All shingles are hashed into m segments. Of a pair that differs in at most H
elements, at least m - H segments are equal; and if each segment may differ by one element (found by its
one-deletion neighbourhood), half as many segments do. So with a few segments more than needed, a pair
shares a segment's signature even if each document leaves its k dearest signatures out.

Sizes fall into bands that grow by 5/4. A scheme belongs to the band of the larger set; a set takes part
in its own scheme and in those of the larger sets it can pair with. For each scheme the number of
segments, the spare ones, the use of deletions and the number of independent partitions are those of the
least cost: signatures sent, plus pairs expected from segments too small to tell sets apart.

1. Equal sets become one node (a shuffle of set keys).
2. Signatures of which no other node has one are dropped (a shuffle of 32 bits per signature).
   A node stays only with as many shared segments as a link must have (the spare ones and one more).
3. Nodes are compared with one centre node per shared signature: linear in the signatures, and enough
   to tie big groups of near copies together.
4. Signatures whose nodes are still in several components give the pairs between components. Dear ones
   are paid for from the spare segments; a node that has more of them than it can spare keeps the
   cheapest. So a signature gives a bounded number of pairs, and no link between components is lost.

A pair whose sets must differ in too many elements is left out by the join that makes it: each node has
a bitmap, in which every element of its set flips one bit, so two bitmaps differ in no more bits than the
sets do in elements. The other pairs are verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffscope.llm import blocks as B
from tariffscope.llm.graph import components
from tariffscope.llm.hashing import join_texts, mix, window_names, word_names, word_spans
from tariffscope.session import materialize

U = np.uint64
SHINGLE = 5
#: A signature is dear when it would give more pairs than the square of this.
DEAR = 16
#: Words of 64 bits in a node's bitmap. More would tell larger sets apart, at eight bytes a node.
BITMAP = 16
BITS = [f"b{i}" for i in range(BITMAP)]
#: Words of the bitmap folded for the signature join, where it takes eight bytes a node and signature each.
FOLDED = 4
#: Bytes of text whose words and shingles a task holds at once, or one longer text.
SET_BYTES = 1 << 20

LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


class Sets:
    """The shingle sets of texts: names in ``names``, those of text d at bounds[d:d+2]."""

    def __init__(self, texts: list[bytes], shingle: int):
        buf, offsets = join_texts([t.translate(LOWER) for t in texts])
        starts, ends = word_spans(buf)
        doc = np.searchsorted(offsets, starts, "right") - 1
        words = word_names(buf, starts, ends)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        n = np.diff(first)
        whole = window_names(words, shingle, 1)
        inside = doc[: len(whole)] == doc[shingle - 1 :] if len(whole) else np.zeros(0, bool)
        owner, names = doc[: len(whole)][inside], whole[inside]
        short = np.flatnonzero((n > 0) & (n < shingle))
        few = np.array([window_names(words[first[d] : first[d + 1]], int(n[d]), 2)[0] + U(n[d]) for d in short.tolist()], U)
        owner, names = np.concatenate([owner, short]), np.concatenate([names, few])
        order = np.lexsort((names, owner))
        owner, names = owner[order], names[order]
        new = np.ones(len(order), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (names[1:] != names[:-1])
        self.owner, self.names = owner[new], names[new]
        self.bounds = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        self.sizes = np.diff(self.bounds)

    def keys(self) -> list[bytes]:
        """Sixteen bytes that name each document's set."""
        parts = []
        for seed in (3, 5):
            sums = np.zeros(len(self.sizes), U)
            np.add.at(sums, self.owner, mix(self.names + U(seed)))
            parts.append(mix(sums + self.sizes.astype(U)))
        return [row.tobytes() for row in np.stack(parts, 1)]

    def bitmaps(self) -> list[np.ndarray]:
        """Per document the words of its bitmap: every element flips one bit."""
        at = mix(self.names + U(17)) % U(64 * BITMAP)
        words = np.zeros((BITMAP, len(self.sizes)), U)
        np.bitwise_xor.at(words, ((at >> U(6)).astype(np.int64), self.owner), U(1) << (at & U(63)))
        return list(words.view(np.int64))


class Scheme:
    """How the sets of one size band and the smaller ones they can pair with are cut into segments."""

    def __init__(self, number: int, low: int, high: int, nodes: int):
        self.number, self.least, self.high = number, -(-4 * low // 5), high
        budget = 2 * high // 9  # elements in which a pair of this band can differ, at most
        choices = []
        for differ in (1, 2):
            for spare in sorted({budget // 4 + i for i in range(4)}):
                for partitions in (1, 2, 3, 4):
                    m = -(-(budget + 1) // differ) + spare
                    choices.append((self._cost(low, nodes, m, differ, spare, partitions), m, differ, spare, partitions))
        _, self.segments, self.differ, self.spare, self.partitions = min(choices)
        self.active = budget > 0
        self.need = self.spare + 1  # segments in which a linked pair agrees, at least

    @staticmethod
    def _cost(size: int, nodes: int, m: int, differ: int, spare: int, partitions: int) -> float:
        mean = size / m
        weak = exp(-mean) * (1 if differ == 1 else 1 + mean) if m > 1 else 0.0
        heavy = 1 - sum(comb(m, i) * weak**i * (1 - weak) ** (m - i) for i in range(spare + 1)) if m < 1000 else _tail(m * weak, spare)
        return partitions * (m + (size if differ == 2 else 0)) + max(0.0, heavy) ** partitions * nodes * max(weak, 1e-3)


def _tail(mean: float, k: int) -> float:
    """Chance that a Poisson variable is above k."""
    term, total = exp(-mean) if mean < 700 else 0.0, 0.0
    for i in range(k + 1):
        total += term
        term *= mean / (i + 1)
    return max(0.0, 1 - total)


def band_edges(largest: int) -> list[int]:
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, -(-5 * edges[-1] // 4)))
    return edges


def signatures(sets: Sets, docs: np.ndarray, schemes: list[Scheme]) -> tuple[np.ndarray, ...]:
    """Signature, document, scheme and partition (as one number) of every segment and deletion of the given documents."""
    out: list[tuple[np.ndarray, ...]] = []
    for s in schemes:
        mine = docs[(sets.sizes[docs] >= s.least) & (sets.sizes[docs] <= s.high)]
        if not s.active or not len(mine):
            continue
        rows = np.repeat(sets.bounds[mine] - np.concatenate([[0], np.cumsum(sets.sizes[mine])[:-1]]), sets.sizes[mine]) + np.arange(sets.sizes[mine].sum())
        token, local = sets.names[rows], np.repeat(np.arange(len(mine)), sets.sizes[mine])
        weight = mix(token + U(11))
        for p in range(s.partitions):
            salt = mix(np.array([s.number * 8 + p + 1], U))[0]
            segment = (mix(token ^ salt) % U(s.segments)).astype(np.int64)
            place = local * s.segments + segment
            sums = np.zeros(len(mine) * s.segments, U)
            np.add.at(sums, place, weight)
            of_segment = mix(np.arange(s.segments, dtype=U) + salt)
            tag = s.number * 8 + p
            out.append((mix(sums ^ np.tile(of_segment, len(mine))), np.repeat(mine, s.segments), np.full(len(sums), tag), np.tile(np.arange(s.segments), len(mine)), np.zeros(len(sums), bool)))
            if s.differ == 2:
                out.append((mix((sums[place] - weight) ^ of_segment[segment]), mine[local], np.full(len(place), tag), segment, np.ones(len(place), bool)))
    if not out:
        return np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


NODE_SETS = "node bigint, items array<bigint>"
SET_ROWS = ", ".join(["doc_id bigint, block bigint, at int, n bigint, set_key binary", *(f"{b} bigint" for b in BITS)])
SIGNED = "sig bigint, node bigint, n int, tag int, segment int, deleted boolean"


def _slices(texts: list[bytes]) -> Iterator[slice]:
    """Runs of texts of up to SET_BYTES."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SET_BYTES:
            yield slice(first, i)
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def _with_column(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[B.Block, list]]:
    for batch in batches:
        values = batch.column(batch.schema.names.index(column))
        for block, value in zip(B.opened(iter([batch])), values, strict=True):
            yield block, value.as_py() or []


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Classes of documents linked by 100 * shared >= 80 * united word shingles.

    Texts are lower-cased in A-Z; words are runs of anything but blanks and code points 9 to 13. A set
    holds the distinct runs of ``shingle`` words; a shorter text is one shingle. Returns doc_id,
    n_shingles, component_id (the smallest doc_id reachable by links, itself included), n_spanning_links (verified
    links of the document's node that were needed to tie the classes), n_copies (documents with an equal set).

    Null, empty and blank texts have no shingles and are linked with nothing. A null id is never the
    smallest; a class of null ids alone has a null component_id. Rows with equal ids are separate
    documents. Empty tables give empty results; other columns are ignored.
    """
    packed = B.pack(docs, id_col, text_col)
    size = B.text_bytes(packed)

    def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.opened(batches):
            ids = block.id_column()
            for part in _slices(block.texts):
                sets = Sets(block.texts[part], shingle)
                at = range(part.start, part.stop)
                yield pa.RecordBatch.from_arrays(
                    [ids[part], pa.array([block.number] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(sets.sizes, pa.int64()), pa.array(sets.keys(), pa.binary()), *map(pa.array, sets.bitmaps())],
                    ["doc_id", "block", "at", "n", "set_key", *BITS],
                )

    rows = materialize(packed.mapInArrow(set_rows, SET_ROWS), "sets")
    nodes = materialize(
        rows.where("n > 0").groupBy("set_key", "n").agg(F.min(F.struct("block", "at")).alias("p"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), *(F.first(b).alias(b) for b in BITS))
        .select("set_key", (F.shiftleft("p.block", 17) + F.col("p.at")).alias("node"), "n", "p.block", "p.at", "first_id", "copies", *BITS),
        "nodes",
    )
    links = _links(packed, nodes, size, shingle)
    roots = materialize(components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))), "roots")
    degree = links.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(F.count("*").alias("n_spanning_links"))
    known = nodes.join(roots, "node", "left").join(degree, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = known.join(least, "root").select("set_key", "component_id", "copies", F.coalesce("n_spanning_links", F.lit(0).cast("bigint")).alias("n_spanning_links"))
    # the node of an empty text is in no class
    found = rows.join(classes, "set_key", "left")
    empty = F.col("n") == 0
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.lit(0).cast("bigint")).otherwise(F.col("n_spanning_links")).alias("n_spanning_links"),
        F.when(empty, F.lit(1).cast("bigint")).otherwise(F.col("copies")).alias("n_copies"),
    )


def _schemes(nodes: DataFrame) -> list[Scheme]:
    """One scheme per size band; their number grows with the logarithm of the largest set."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    edges = band_edges(max(1, largest))
    counts = dict(nodes.groupBy(F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).alias("b")).agg(F.count("*")).collect())
    near = lambda low: sum(counts.get(int(np.log(low) / np.log(1.25)) + i, 0) for i in (-1, 0, 1))
    return [Scheme(i, low, edges[i + 1] - 1, near(low)) for i, low in enumerate(edges[:-1])]


def _links(packed: DataFrame, nodes: DataFrame, size: int, shingle: int) -> DataFrame:
    """Verified links (x, y), enough of them to tie every class together."""
    schemes = _schemes(nodes)
    bits = B.bucket_bits(size // 2)
    speakers = nodes.groupBy("block").agg(F.collect_list(F.struct("at", "node")).alias("speakers"))
    armed = packed.join(speakers, "block")

    needs = np.array([s.need for s in schemes], np.int64)

    def signed(block: B.Block, who: list) -> tuple:
        """Set sizes of the nodes of a block, and their signatures; the sets of a few texts are held at a time."""
        texts, sizes, found = [block.texts[w["at"]] for w in who], [], []
        for part in _slices(texts):
            sets = Sets(texts[part], shingle)
            sig, doc, *told = signatures(sets, np.arange(len(sets.sizes)), schemes)
            sizes.append(sets.sizes)
            found.append((sig, doc + part.start, *told))
        return np.concatenate(sizes), tuple(map(np.concatenate, zip(*found, strict=True)))

    key_field = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("f0", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, who in _with_column(batches, "speakers"):
            asked = list(B.Keys.of(signed(block, who)[1][0], bits).questions(bits))
            if asked:
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in asked], pa.int32()), pa.array([block.number] * len(asked), pa.int64()), pa.array([f[0] for _, f in asked], pa.binary())], schema=key_field)

    def reply(key: tuple, table: pa.Table) -> pa.Table:
        numbers = table.column("block").to_pylist()
        bodies = B.seen_twice(numbers, [[x] for x in table.column("f0").to_pylist()])
        return pa.table({"block": pa.array(numbers, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(numbers), pa.int32()), "body": pa.array(bodies, pa.binary())})

    replies = materialize(armed.mapInArrow(ask, "bucket int, block bigint, f0 binary").groupBy("bucket").applyInArrow(reply, B.ANSWERS), "signature_keys")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, who in _with_column(batches, "speakers"):
            sizes, (sig, doc, tag, segment, deleted) = signed(block, who)
            keep = np.flatnonzero(B.Keys.of(sig, bits).shared(block.answers))
            keep = keep[_enough(doc[keep], tag[keep], segment[keep], needs)]
            names = np.array([w["node"] for w in who], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[keep].view(np.int64)), pa.array(names[doc[keep]]), pa.array(sizes[doc[keep]], pa.int32()), pa.array(tag[keep], pa.int32()), pa.array(segment[keep], pa.int32()), pa.array(deleted[keep])],
                ["sig", "node", "n", "tag", "segment", "deleted"],
            )

    signed_rows = materialize(B.with_answers(packed, replies).join(speakers, "block").mapInArrow(shared, SIGNED), "signed")
    need = F.create_map(*[F.lit(v) for s in schemes for v in (s.number, s.need)])[F.floor(F.col("tag") / 8).cast("int")]
    sig_of = signed_rows.select("sig", "node", "n", "tag", "segment")
    fits = (F.least("xn", "yn") * 5 >= F.greatest("xn", "yn") * 4) & (F.col("xr") != F.col("yr"))

    def stars(rows: DataFrame, order) -> DataFrame:
        """Pairs of a centre of a signature and another of its nodes that is not in the centre's component."""
        centre = rows.groupBy("sig").agg(F.min_by(F.struct("node", "n", "root"), order).alias("c"))
        pairs = rows.join(centre, "sig").select(
            F.col("c.node").alias("x"), F.col("c.n").alias("xn"), F.col("c.root").alias("xr"), F.col("node").alias("y"), F.col("n").alias("yn"), F.col("root").alias("yr"), "tag", "segment"
        )
        # a first guess at links: those with a third of the agreement that a link has
        some = pairs.where(fits).groupBy("x", "y", "tag").agg(F.count_distinct("segment").alias("c")).where(F.col("c") * 3 >= need)
        return _alike(_ordered(some), nodes)

    first = stars(sig_of.withColumn("root", F.col("node")), F.xxhash64("node"))
    done = materialize(_verified(packed, nodes, first, shingle), "links")
    roots = materialize(components(done.where("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))), "roots")
    named = sig_of.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # signatures that still touch several components, and another centre for each
    per_root = named.groupBy("sig", "root").agg(F.count("*").alias("k"))
    spread = per_root.groupBy("sig").agg(F.sum("k").alias("total"), F.max("k").alias("most"), F.count("*").alias("roots")).where("roots > 1")
    spread = materialize(spread.select("sig", "total", (F.col("total") - F.col("most")).alias("rest")), "spread")
    second = stars(named.join(spread, "sig"), F.xxhash64("node", F.lit(1))).join(done.select("x", "y"), ["x", "y"], "left_anti")
    done = materialize(done.union(_verified(packed, nodes, second, shingle)), "links")
    roots = materialize(components(done.where("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))), "roots")
    rest = _between(signed_rows, spread, nodes, roots, schemes, need).join(done.select("x", "y"), ["x", "y"], "left_anti")
    done = materialize(done.union(_verified(packed, nodes, rest, shingle)), "links")
    return done.where("linked").select("x", "y")


def _enough(doc: np.ndarray, tag: np.ndarray, segment: np.ndarray, needs: np.ndarray) -> np.ndarray:
    """Rows of documents with as many shared segments in a partition as a linked pair must agree on."""
    if not len(doc):
        return np.zeros(0, bool)
    order = np.lexsort((segment, tag, doc))
    doc, tag, segment = doc[order], tag[order], segment[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
    fresh = new | np.concatenate([[True], segment[1:] != segment[:-1]])
    group = np.cumsum(new) - 1
    enough = np.bincount(group, fresh) >= needs[tag[new] // 8]
    out = np.empty(len(order), bool)
    out[order] = enough[group]
    return out


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose bitmaps do not rule a link out; only their sets are fetched and compared."""
    x = nodes.select(F.col("node").alias("x"), F.col("n").alias("xn"), *(F.col(b).alias(f"x{b}") for b in BITS))
    y = nodes.select(F.col("node").alias("y"), F.col("n").alias("yn"), *(F.col(b).alias(f"y{b}") for b in BITS))
    return pairs.join(x, "x").join(y, "y").where(_apart(BITS) * 9 <= F.col("xn") + F.col("yn")).select("x", "y")


def _apart(words: list[str]):
    """Bits in which the bitmaps of x and y differ: never more than the sets do."""
    return sum((F.bit_count(F.col(f"x{b}").bitwiseXOR(F.col(f"y{b}"))) for b in words), F.lit(0))


def _folded() -> list:
    """The bitmap in a quarter of its words: every element still flips one bit."""
    return [reduce(lambda a, b: a.bitwiseXOR(b), map(F.col, BITS[i::FOLDED])).alias(BITS[i]) for i in range(FOLDED)]


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _between(signed: DataFrame, spread: DataFrame, nodes: DataFrame, roots: DataFrame, schemes: list[Scheme], need) -> DataFrame:
    """All pairs of different components that share a signature which neither side could spare, and whose bitmaps agree enough."""
    spares = F.create_map(*[F.lit(v) for s in schemes for v in (s.number, s.spare)])
    rows = signed.join(spread, "sig").withColumn("dear", F.col("rest") * F.col("total") > DEAR * DEAR)
    cost = F.col("rest") * F.col("total")
    # a segment is as dear as its dearest signature; a node spares its dearest segments
    segments = rows.where("dear").groupBy("node", "tag", "segment").agg(F.max(cost).alias("cost"))
    rank = F.row_number().over(Window.partitionBy("node", "tag").orderBy(F.desc("cost"), "segment"))
    unpaid = segments.withColumn("r", rank).where(F.col("r") > spares[F.floor(F.col("tag") / 8).cast("int")])
    # with several partitions it is enough that one of them is paid for
    partitions = F.create_map(*[F.lit(v) for s in schemes for v in (s.number, s.partitions)])
    scheme = F.floor(F.col("tag") / 8).cast("int")
    failed = unpaid.select("node", "tag").distinct().groupBy("node", scheme.alias("scheme")).agg(F.count("*").alias("c"))
    failed = failed.where(F.col("c") >= partitions[F.col("scheme")]).select("node", "scheme")
    kept = unpaid.withColumn("scheme", scheme).join(failed, ["node", "scheme"]).select("node", "tag", "segment", F.lit(True).alias("needs"))
    rows = rows.join(kept, ["node", "tag", "segment"], "left").withColumn("needs", F.coalesce("needs", F.lit(False)))
    # agreement in dear segments is not seen, so that much less of it is asked for
    unseen = segments.groupBy("node", "tag").agg(F.count("*").alias("unseen"))
    rows = rows.join(unseen, ["node", "tag"], "left").withColumn("least", F.greatest(F.lit(1), need - F.coalesce("unseen", F.lit(0))))
    words = BITS[:FOLDED]
    known = nodes.select("node", *_folded()).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = materialize(rows.join(known, "node").select("sig", "node", "n", "tag", "segment", "root", "dear", "needs", "deleted", "least", *words), "open")
    fits = (F.least("xn", "yn") * 5 >= F.greatest("xn", "yn") * 4) & (_apart(words) * 9 <= F.col("xn") + F.col("yn"))

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        side = lambda df, c, *more: df.select("sig", *more, *(F.col(k).alias(c + k) for k in ("n", "root", "deleted", "least", *words)), F.col("node").alias(c))
        pairs = side(left, "x", "tag", "segment").join(side(right, "y"), "sig")
        return pairs.where((F.col("xroot") != F.col("yroot")) & ~(F.col("xdeleted") & F.col("ydeleted")) & fits)

    # one dear signature is enough, so that its pairs need no count; the others are counted once, not from either side
    dear, cheap = rows.where("dear"), rows.where("not dear")
    certain = _ordered(met(dear.where("needs"), dear))
    agreed = met(cheap, cheap).where("x < y").groupBy("x", "y", "tag").agg(F.count_distinct("segment").alias("c"), F.max(F.least("xleast", "yleast")).alias("least"))
    pairs = certain.union(agreed.where(F.col("c") >= F.col("least")).select("x", "y"))
    # what the folded bitmaps could not tell apart, the whole ones do
    return _alike(pairs.distinct(), nodes)


def _verified(packed: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """The pairs with a flag: do they share four fifths of their union?"""
    pairs = materialize(pairs, "pairs")
    wanted = nodes.join(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct(), "node")
    lists = wanted.groupBy("block").agg(F.collect_list(F.struct("at", "node")).alias("wanted"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, who in _with_column(batches, "wanted"):
            texts = [block.texts[w["at"]] for w in who]
            for part in _slices(texts):
                sets = Sets(texts[part], shingle)
                items = np.split(sets.names.view(np.int64), sets.bounds[1:-1])
                yield pa.RecordBatch.from_arrays([pa.array([w["node"] for w in who[part]], pa.int64()), pa.array(items, pa.list_(pa.int64()))], ["node", "items"])

    items = materialize(packed.join(lists, "block").mapInArrow(fetch, NODE_SETS), "items")
    both = pairs.join(items.select(F.col("node").alias("x"), F.col("items").alias("xi")), "x").join(items.select(F.col("node").alias("y"), F.col("items").alias("yi")), "y")
    shared = F.size(F.array_intersect("xi", "yi"))
    united = F.size("xi") + F.size("yi") - shared
    return both.select("x", "y", (shared * 100 >= united * 80).alias("linked"))
