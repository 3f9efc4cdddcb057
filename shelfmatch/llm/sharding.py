"""Sharding: a minimax contiguous partition of ordered groups of equal texts."""

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfmatch.llm.common import quoted, spare, without
from shelfmatch.sources.staging import broadcast_if_small, stage

POSITION_BITS = 62
FIRST_BITS = 12  # of the first table of segments
MOST_SEGMENTS = 1 << 16  # new segments that the driver reads per round
SLOT_ROWS = 10_000  # rows that one task numbers, about


def position(text: Column) -> Column:
    """Where a text stands in the order: equal texts at one place. Two texts that share one by chance stay together."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - POSITION_BITS)


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


class Segments:
    """Prefix sums over ranges of positions; a range with one group is exact, others can be split."""

    def __init__(self, groups: DataFrame, first_bits: int, most: int):
        self.groups, self.most = groups, most
        width = POSITION_BITS - first_bits
        self.rows = self._read(groups, width)
        self._sum()

    @staticmethod
    def _read(groups: DataFrame, width: int) -> list[tuple[int, int, int, int]]:
        """(start, width in bits, size, groups), in order."""
        start = F.shiftleft(F.shiftright("position", width), width)
        rows = groups.groupBy(start.alias("start")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
        return sorted((r.start, width, r.size, r.n) for r in rows)

    def _sum(self) -> None:
        self.ends, total = [0], 0
        for row in self.rows:
            total += row[2]
            self.ends.append(total)
        self.total = total

    def below(self, x: int) -> tuple[int, int, int | None]:
        """The least and greatest value that the last cut point at or below ``x`` can have; the segment to split."""
        if x >= self.total:
            return self.total, self.total, None
        i = bisect_right(self.ends, x) - 1
        if self.ends[i] == x or self.rows[i][3] == 1:
            return self.ends[i], self.ends[i], None
        return self.ends[i], x, i

    def above(self, x: int) -> tuple[int, int | None]:
        """The first segment end at or above ``x``; the segment to split, if a cut point may come sooner."""
        if x <= 0:
            return 0, None
        i = bisect_right(self.ends, x - 1)
        return self.ends[i], i - 1 if self.rows[i - 1][3] > 1 and self.ends[i] != x else None

    def between(self, low: int, high: int) -> set[int]:
        """Segments of several groups that reach into [low, high]."""
        i, found = max(0, bisect_right(self.ends, low) - 1), set()
        while i < len(self.rows) and self.ends[i] <= high:
            if self.rows[i][3] > 1:
                found.add(i)
            i += 1
        return found

    def split(self, which: set[int]) -> None:
        """Read the given segments anew in finer ranges: one small aggregation per width."""
        more = max(1, (self.most // max(1, len(which))).bit_length() - 1)
        fresh = [row for i, row in enumerate(self.rows) if i not in which]
        for width in {self.rows[i][1] for i in which}:
            starts = [self.rows[i][0] >> width for i in which if self.rows[i][1] == width]
            wanted = self.groups.sparkSession.createDataFrame([(s,) for s in starts], "prefix long")
            inside = self.groups.withColumn("prefix", F.shiftright("position", width)).join(F.broadcast(wanted), "prefix", "left_semi")
            fresh += self._read(inside, max(0, width - more))
        self.rows = sorted(fresh)
        self._sum()


def smallest_capacity(segments: Segments, shards: int) -> int:
    """Binary search for the least capacity with which a greedy pass needs at most ``shards`` shards.

    While segments still hide cut points, the pass gives a sure answer for some capacities only; the segments where
    the other capacities may cut are split and the search goes on between.
    """
    def reach(capacity):  # after each shard: least and greatest value of the cut
        low = high = 0
        steps = []
        for _ in range(shards):
            low, high = segments.below(low + capacity)[0], segments.below(high + capacity)[1]
            steps.append((low, high))
        return steps

    def least(test, low, high):
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if test(mid) else (mid + 1, high)
        return low

    while True:
        total = segments.total
        sure = least(lambda c: reach(c)[-1][0] >= total, 0, total)
        maybe = least(lambda c: reach(c)[-1][1] >= total, 0, sure)
        if sure == maybe:
            return sure
        open_ = set()
        for (low, _), (_, high) in zip(reach(maybe), reach(sure), strict=True):
            open_ |= segments.between(low, high)
        if not open_:
            return sure
        segments.split(open_)


def cut_points(segments: Segments, shards: int) -> list[int]:
    """Cuts under the smallest capacity. Among those, each shard ends as near to an even share of the rest as the
    capacity and what must still fit behind allow; a greedy pass alone would leave the last shard what remains."""
    capacity = smallest_capacity(segments, shards)
    while True:
        open_: set[int] = set()

        def below(x, seen=open_):
            value, _, split = segments.below(x)
            seen.update([split] if split is not None else [])
            return value

        def above(x, seen=open_):
            value, split = segments.above(x)
            seen.update([split] if split is not None else [])
            return value

        latest = [segments.total]  # from the back: the least cut after which the rest fits
        for _ in range(shards - 1):
            latest.append(above(max(0, latest[-1] - capacity)))
        latest = latest[::-1]
        cuts, start = [], 0
        for k in range(shards - 1):
            even = start + (segments.total - start) // (shards - k)
            under, over = below(even), above(even)
            near = under if even - under <= over - even else over
            start = max(latest[k], min(near, below(start + capacity)), start)
            cuts.append(start)
        if not open_:
            return cuts
        segments.split(open_)


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row into one of ``shards`` shards of near equal bytes (UTF-8 size of the text plus one); rows of equal
    text stay in one shard. Adds ``size``, ``shard`` and ``slot`` (from 0 without gaps in each shard).

    Groups of equal texts are never split. Those above the mean size of what is left come first, in a shard each; the
    others follow in the order of a hash of the text and are cut under the smallest capacity. A null text counts as an
    empty one.
    Repeated rows and rows without a ``doc_id`` each get a slot of their own. Columns named like those added are
    replaced. An empty table gives an empty result. ``docs`` should be a scan of files or a staged table: rows are told
    apart by where they stand in it.

    Equal texts are summed before the shuffle. The driver sees sums over ranges of positions only (at most
    ``MOST_SEGMENTS`` new ones a round); the cuts become literals in a column expression, so no row is joined. Slots
    are numbered within small buckets of rows and moved by the counts of the buckets before. Rows that agree in id and
    text, if they are many, are dealt to as many buckets as they fill.
    """
    docs = without(docs, "size", "shard", "slot")
    place = position(quoted(text))
    groups = stage(docs.groupBy(place.alias("position")).agg(F.sum(text_size(quoted(text))).alias("size")), "groups")
    rows = docs.count()
    giants = groups_above_mean(groups, shards)
    segments = Segments(groups.where(~F.col("position").isin(giants)) if giants else groups, FIRST_BITS, MOST_SEGMENTS)
    starts = first_positions(segments, cut_points(segments, shards - len(giants))) if segments.total else []

    p, bucket, before, copies, alike = spare(docs, "position", "bucket", "before", "copies", "alike")
    shard = sum([(F.col(p) >= F.lit(s)).cast("int") for s in starts], F.lit(len(giants)))
    for i, giant in enumerate(giants):
        shard = F.when(F.col(p) == F.lit(giant), F.lit(i)).otherwise(shard)
    buckets = max(1, rows // (SLOT_ROWS * shards))
    placed = docs.withColumn(p, place).withColumn("size", text_size(quoted(text))).withColumn("shard", shard)
    key = F.xxhash64(quoted(doc_id), F.col(p))
    many = stage(docs.withColumn(p, place).groupBy(key.alias(alike)).agg(F.count(F.lit(1)).alias(copies)).where(F.col(copies) > SLOT_ROWS), "many-copies")
    placed = placed.withColumn(alike, key).join(broadcast_if_small(many), alike, "left")
    apart = F.pmod(F.monotonically_increasing_id(), F.ceil(F.col(copies) / SLOT_ROWS))  # 0 to the number of buckets they fill
    placed = placed.withColumn(bucket, F.pmod(F.xxhash64(alike, F.coalesce(apart, F.lit(0))), F.lit(buckets))).drop(alike, copies)
    counts = placed.groupBy("shard", bucket).count()
    earlier = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", bucket, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy("shard", bucket).orderBy(quoted(doc_id), p)
    numbered = placed.withColumn("slot", F.row_number().over(inside) - 1)
    joined = numbered.join(offsets, ["shard", bucket])
    return joined.select(*[quoted(c) for c in docs.columns], "size", "shard", (F.col(before) + F.col("slot")).alias("slot"))


def groups_above_mean(groups: DataFrame, shards: int) -> list[int]:
    """Positions of the groups that fill a shard of their own: largest first, while a group is above the mean of what
    is left. There are fewer than ``shards``, so as many rows are enough to look at."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    found = []
    for row in groups.orderBy(F.desc("size"), "position").limit(shards - 1).collect():
        if row["size"] * (shards - len(found)) <= total:
            break
        found.append(row["position"])
        total -= row["size"]
    return found


def first_positions(segments: Segments, cuts: list[int]) -> list[int]:
    """The position at which each shard after the first begins; beyond all positions if it is empty."""
    beyond = 1 << POSITION_BITS
    found = []
    for cut in cuts:
        i = bisect_right(segments.ends, cut) - 1
        found.append(segments.rows[i][0] if i < len(segments.rows) else beyond)
    return found
