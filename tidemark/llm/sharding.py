"""Contiguous shards of near equal size that keep equal texts together.

Rows are put in one order, groups of equal texts by their smallest id; shards are runs of whole groups. The
capacity is the smallest for which the shards suffice, found by a binary search whose checks fill shard after
shard greedily. A check asks for "the last group that ends by x"; the ends of the groups are counted in a fixed number of cells, the cells
that a search has asked for are counted in finer ones, and the search is repeated until every answer was exact. Within that capacity each cut is then made as near to an equal share of
what is left as it can be, so that one group larger than a share does not leave other shards empty.

All of it is DataFrame operations. Rows are ordered by range partitioning and totals carried from partition to
partition, so neither a frequent text nor the whole table meets in one task; the driver sees sums and cuts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.topn import Order
from .common import stage, text_digest, utf8_length

#: Cells in which the ends of groups are counted at once.
_CELLS = 1 << 15
_PLACE_BITS = 33


def _in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``before``, the rows ahead of each, and ``upto``, the sum of ``size`` including it."""
    placed = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "shard-order")
    placed = placed.withColumn("part", F.shiftright("place", _PLACE_BITS))
    sums = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    sums = sums.select("part", *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_ahead") for c in ("rows", "bytes")))
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn("run", F.sum("size").over(within)).join(sums, "part").select(
        "*", (F.col("rows_ahead") + F.col("place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).alias("before"),
        (F.col("bytes_ahead") + F.col("run")).alias("upto")).drop("part", "place", "rows_ahead", "bytes_ahead", "run")


class _Ends:
    """The ends of the groups on the line from 0 to ``total``, as far as they are known.

    ``known`` are ends, rising; where ``open_`` holds, others may lie between one and the next. A look-up there answers with the known end before and
    notes the place. Those places are then looked into, all in one pass, and everything is computed anew until no answer was a guess.
    """

    def __init__(self, ends: DataFrame, total: int, largest: int):
        self.ends, self.total, self.largest = ends, total, largest
        self.known, self.open_, self.guessed = np.array([0, total]), np.array([True]), {0}
        self.look()

    def look(self) -> None:
        """Count the ends at the guessed places in cells; a fixed number of cells comes to the driver."""
        places = sorted(self.guessed)
        starts, ends = self.known[places], self.known[np.array(places) + 1]
        each = max(2, _CELLS // len(places))
        at, upto = F.col("at"), F.col("upto")
        low, high = (F.get(F.lit([int(x) for x in some]), at) for some in (starts, ends))
        inside = self.ends.filter(upto.between(int(starts[0]), int(ends[-1])))
        inside = inside.withColumn("at", Order(inside, ["upto"]).passed([(int(x),) for x in starts]) - 1).filter((at >= 0) & (upto < high))
        cell = ((upto - low).cast("double") * each / (high - low).cast("double")).cast("int")
        found = inside.groupBy("at", cell.alias("cell")).agg(F.min("upto").alias("first"), F.max("upto").alias("last"), F.count(F.lit(1)).alias("n")).collect()
        self.open_[places] = False
        new = [(r["first"], r["n"] > 2) for r in found] + [(r["last"], False) for r in found if r["last"] > r["first"]]
        if new:
            known = np.concatenate([self.known, [x for x, _ in new]])
            open_ = np.concatenate([self.open_, [False], [o for _, o in new]])
            order = np.argsort(known, kind="stable")
            self.known, self.open_ = known[order], open_[order][:-1]
        self.guessed = set()

    def _place(self, point: int) -> int:
        at = int(np.searchsorted(self.known, point, "right")) - 1
        if at < len(self.open_) and self.open_[at] and point > self.known[at]:
            self.guessed.add(at)
        return at

    def last_by(self, points: list[int]) -> list[int]:
        """For each of the points, which are over 0, the last end at or before it (0 if there is none)."""
        return [int(self.known[self._place(p)]) for p in points]

    def around(self, point: int) -> tuple[int, int]:
        """The last end at or before the point (or 0), and the first at or after it (or the total)."""
        at = self._place(point)
        return int(self.known[at]), int(self.known[at] if self.known[at] == point else self.known[min(at + 1, len(self.known) - 1)])


def _fits(ends: _Ends, capacity: int, shards: int) -> bool:
    """Whether greedily filled shards take everything."""
    at = 0
    for _ in range(shards):
        [at] = ends.last_by([at + capacity])
    return at == ends.total


def _smallest_capacity(ends: _Ends, shards: int) -> int:
    low = max(-(-ends.total // shards), ends.largest)
    high = max(low, -(-ends.total // shards) + ends.largest)  # a shard ends only when it holds a share: this always fits
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if _fits(ends, middle, shards) else (middle + 1, high)
    return high


def _cuts(ends: _Ends, shards: int, capacity: int) -> list[int]:
    """Where the shards end, all but the last: near equal shares, none over the capacity."""
    least = [ends.total]  # the earliest ends from which the remaining shards can still take the rest
    for _ in range(shards - 1):
        least.append(0 if least[-1] <= capacity else ends.around(least[-1] - capacity)[1])
    cuts, start = [], 0
    for left in range(shards, 1, -1):
        share = start + -(-(ends.total - start) // left)
        if share >= ends.total:
            cut = ends.total
        else:
            low, high = ends.around(share)
            cut = high if high - share <= share - low and high - start <= capacity else low
            cut = max(cut, least[left - 1], start)
        cuts.append(cut)
        start = cut
    return cuts


def _count_below(cuts: list[int], value: Column) -> Column:
    return sum(((value > c).cast("int") for c in cuts), start=F.lit(0))


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs``.

    A row's size is the UTF-8 bytes of its text and ``overhead``; rows with equal texts form a group, NULL
    texts (without bytes, checksum 0) too, and a group is never cut. The largest shard is as small as the
    order of the groups allows (law ``bytes``). ``slot`` counts each shard's rows from 0; rows that repeat take slots of
    their own. With fewer groups than shards some stay empty, and an empty table gives an empty result.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(text_digest(text), F.lit(b"")).alias("digest"), (utf8_length(text) + overhead).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"), F.spark_partition_id().alias("origin"))
    copies = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # read anew, with the rows on the left, so that Spark can split the partition of a frequent text
    grouped = rows.join(stage(copies, "shard-copies"), "digest", "left").withColumn("first", F.coalesce("first", "id"))
    placed = stage(_in_order(grouped, ["first", "digest", "id", "origin"]), "shard-rows")
    sums = placed.groupBy("first", "digest").agg(F.max("upto").alias("upto"), F.sum("size").alias("size"))
    ends = stage(sums.repartitionByRange("upto").sortWithinPartitions("upto"), "shard-groups")
    total, largest = ends.agg(F.max("upto"), F.max("size")).first()
    kind = docs.schema[id_col].dataType
    shown = [F.col("id").cast(kind).alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law")]
    if total is None:
        return placed.select(*shown, F.lit(0).alias("shard"), "before", F.lit(None).cast("int").alias("grown_shard")).withColumnRenamed("before", "slot")
    line = _Ends(ends.select("upto"), total, largest)
    cuts = _cuts(line, shards, _smallest_capacity(line, shards))
    while line.guessed:
        line.look()
        cuts = _cuts(line, shards, _smallest_capacity(line, shards))
    shard = _count_below(cuts, F.col("upto"))
    starts = dict(placed.filter(F.col("upto").isin(sorted(set(cuts)))).select("upto", F.col("before") + 1).collect())
    first_slots = F.array(F.lit(0).cast("bigint"), *(F.lit(starts.get(c, 0)).cast("bigint") for c in cuts))
    return placed.select(
        *shown, shard.alias("shard"), (F.col("before") - F.get(first_slots, shard)).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
