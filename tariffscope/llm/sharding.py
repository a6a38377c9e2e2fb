"""Sharding by balanced label propagation: linked documents move together, shards stay even.

Documents of one group (equal texts) are linked with each other. Every linked document starts in the
shard of its hash. In a round each group counts its members per shard (a Spark aggregation; a group's
links are a star around its key, so nothing is quadratic), and members elsewhere ask to move to the shard
where most are. A group too big for one shard may stay in as many of its fullest shards as it needs. A
shard admits movers only up to its quota. Rounds end when nobody moves.

Groups that are whole then (or in no more shards than they need) stay. The others are settled by size,
largest first, each in the shard with the most room; one that fits nowhere fills the roomiest shards.
Every such cut fills a shard up, so at most one group fewer than there are shards is cut. If room was too
scattered for a group that one shard can hold, all groups are settled anew and the layout with fewer cuts
is taken. The number of cut groups is logged.

Documents without links have no edges to cut and fill the shards up to their quotas, so counts differ by
one at most. Only shard totals (one number per shard) reach the driver.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffscope.llm.ranks import numbered
from tariffscope.session import materialize

SHARDS = 24

_log = logging.getLogger(__name__)


def _per_shard(rows: DataFrame, shards: int) -> list[int]:
    counts = dict(rows.groupBy("shard").agg(F.count("*")).collect())
    return [counts.get(s, 0) for s in range(shards)]


def _at(values: list[int], shard):
    return F.get(F.array(*[F.lit(v).cast("bigint") for v in values]), shard)


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", rounds: int = 6) -> DataFrame:
    """Shard and slot of every document: equal texts together as far as quotas allow, counts at most one apart.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32 (unsigned), law ("rows"), shard, slot
    (0, 1, 2... within the shard) and grown_shard (null under this law).

    A null text is taken for an empty one; null ids and rows with equal ids are documents like all others.
    Ties between shards go by a hash of the group. With fewer documents than shards the last shards stay
    empty. Empty tables give empty results; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 8).cast("bigint").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("g"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    group = ["g", "text_crc32", "size"]
    members = rows.groupBy(*group).agg(F.count("*").alias("members"), F.min("row").alias("group")).where("members > 1")
    linked = materialize(rows.join(members, group).select("row", "group", "members"), "linked")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    placed = propagate(linked, quota, rounds)

    placed = numbered(settled(placed, quota), ["shard"], "row", "slot")
    placed = materialize(placed.select("row", "shard", "slot"), "placed")
    held = _per_shard(placed, shards)
    loose = materialize(numbered(rows.join(placed, "row", "left_anti").select("row", F.lit(0).alias("all")), ["all"], "row", "n"), "loose")
    ends, at = [], 0
    for s in range(shards):
        at += quota[s] - held[s]
        ends.append(at)
    number = F.size(F.filter(F.array(*[F.lit(e).cast("bigint") for e in ends]), lambda e: e <= F.col("n")))
    begins = [ends[s] - (quota[s] - held[s]) for s in range(shards)]
    filled = loose.withColumn("shard", number).select("row", "shard", (F.col("n") - _at(begins, F.col("shard")) + _at(held, F.col("shard"))).alias("slot"))
    return rows.join(placed.union(filled), "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def propagate(linked: DataFrame, quota: list[int], rounds: int) -> DataFrame:
    """(row, group, members, shard) after the moves; ``linked`` has row, group and members."""
    shards = len(quota)
    now = materialize(linked.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")), "labels")
    need = F.ceil(F.col("members") / max(1, min(quota)))
    for _ in range(rounds):
        held = _per_shard(now, shards)
        votes = now.groupBy("group", "members", "shard").agg(F.count("*").alias("votes"))
        rank = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("votes"), F.xxhash64("group", "shard"), "shard"))
        homes = votes.withColumn("r", rank).where(F.col("r") <= need).groupBy("group").agg(F.sort_array(F.collect_list(F.struct("r", "shard"))).alias("homes"))
        told = now.join(homes, "group")
        own = F.exists("homes", lambda h: h["shard"] == F.col("shard"))
        choice = F.get("homes", F.pmod(F.xxhash64("row", F.lit(7)), F.size("homes")).cast("int"))["shard"]
        wish = materialize(told.withColumn("to", F.when(own, F.col("shard")).otherwise(choice)).drop("homes"), "wishes")
        movers = numbered(wish.where("to <> shard").select("row", "to"), ["to"], "row", "turn")
        leaving = dict(wish.where("to <> shard").groupBy("shard").agg(F.count("*")).collect())
        if not leaving:
            break
        free = [max(0, q - h) for q, h in zip(quota, held, strict=True)]
        admitted = movers.where(F.col("turn") < _at(free, F.col("to"))).select("row", F.col("to").alias("moved"))
        now = materialize(wish.join(admitted, "row", "left").select("row", "group", "members", F.coalesce("moved", "shard").alias("shard")), "labels")
    return now


def _laid(sizes: dict[int, int], room: list[int]) -> tuple[list[tuple], int]:
    """(members, begin, end, shard) for the rows of all groups of a size one after the other, and the number of groups cut.

    ``sizes`` has the number of groups of each size, ``room`` the free places of each shard.
    """
    room = list(room)
    out, cut = [], 0
    for members in sorted(sizes, reverse=True):
        left, at = sizes[members], 0
        while left:
            s = max(range(len(room)), key=lambda k: (room[k], -k))
            if room[s] >= members:
                n = min(left, room[s] // members)
                out.append((members, at, at + n * members, s))
                room[s] -= n * members
                left, at = left - n, at + n * members
                continue
            cut += 1
            rest = members
            while rest:
                s = max(range(len(room)), key=lambda k: (room[k], -k))
                tight = [k for k in range(len(room)) if room[k] >= rest]
                s = min(tight, key=lambda k: (room[k], k)) if tight else s
                n = min(rest, room[s])
                out.append((members, at, at + n, s))
                room[s] -= n
                rest, at = rest - n, at + n
            left -= 1
    return out, cut


def settled(placed: DataFrame, quota: list[int]) -> DataFrame:
    """(row, shard) of all linked rows within the quotas, with few groups cut; ``placed`` comes from :func:`propagate`."""
    shards = len(quota)
    placed = numbered(placed, ["shard"], "row", "turn").withColumn("fits", F.col("turn") < _at(quota, F.col("shard"))).drop("turn")
    placed = materialize(placed, "turns")
    need = F.ceil(F.col("members") / max(1, min(quota)))
    parts = placed.groupBy("group", "members", "shard").agg(F.bool_and("fits").alias("fits"))
    groups = parts.groupBy("group", "members").agg((F.bool_and("fits") & (F.count("*") <= need)).alias("whole"), F.count("*").alias("n"))
    groups = materialize(groups, "groups")
    kept = placed.join(groups.select("group", "whole"), "group")
    held = _per_shard(kept.where("whole"), shards)
    counts = groups.groupBy("members", "whole").agg(F.count("*"), F.sum((F.col("n") > 1).cast("bigint"))).collect()
    ways = [_laid({m: n for m, w, n, _ in counts if not w}, [q - h for q, h in zip(quota, held, strict=True)])]
    split = sum(c for _, w, _, c in counts if w)
    if sum(n for m, w, n, _ in counts if not w and m <= max(quota)) and ways[0][1] > sum(n for m, w, n, _ in counts if not w and m > max(quota)):
        every: dict[int, int] = {}
        for m, _, n, _ in counts:
            every[m] = every.get(m, 0) + n
        ways.append(_laid(every, quota))
    anew = len(ways) > 1 and ways[1][1] < ways[0][1] + split
    pieces, cut = ways[anew]
    _log.info("%d of %d groups are cut", cut + (0 if anew else split), sum(n for _, _, n, _ in counts))
    if not pieces:
        return placed.select("row", "shard")
    moved = groups if anew else groups.where("not whole")
    ranked = numbered(moved.select("group", "members"), ["members"], "group", "n")
    rows = placed.drop("members", "shard").join(ranked, "group")
    rows = numbered(rows, ["group"], "row", "k").withColumn("place", F.col("n") * F.col("members") + F.col("k"))
    table = placed.sparkSession.createDataFrame(pieces, "members bigint, begin bigint, end bigint, shard int")
    found = rows.join(F.broadcast(table), "members").where((F.col("place") >= F.col("begin")) & (F.col("place") < F.col("end"))).select("row", "shard")
    return found if anew else kept.where("whole").select("row", "shard").union(found)
