"""SimHash near-dedup: fingerprints, links by pigeonhole blocks, components by star contraction."""

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import join_counted, quoted, spare, text_blocks
from shelfmatch.sources.staging import stage

BITS, SEED = 64, 42
MOST_BLOCKS = 10
CELL = 2048  # fingerprints of one bucket that one task compares with each other
SMALL = 16  # rows of a bucket up to which neighbours are compared by shifts
PIECE = 1 << 17  # shingles whose bits are unpacked at a time


def fingerprint(text: str | None, words: int) -> int:
    """64-bit SimHash of the text's word shingles, each weighted by how often it occurs."""
    parts = (text or "").encode().lower().split()  # ASCII case and ASCII white space only, as bytes have no other
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    last = ends[min(words, len(parts)) - 1:]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, PIECE):
        cut = zip(starts[at:min(n, at + PIECE)].tolist(), last[at:at + PIECE].tolist())
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in cut])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, BITS // 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint as signed long) of every row; 0 for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, 1):
            values = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            prints = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["doc_id", "fingerprint"])

    source = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, fingerprint long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of ``blocks - distance`` whole blocks: two fingerprints within ``distance`` bits are equal under one."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def choose_blocks(prints: int, distance: int) -> int:
    """The number of blocks with the least expected work (keys, and chance meetings on them) for so many fingerprints.
    It changes the cost only: the links are the same for every choice."""

    def cost(blocks):
        key_bits = (BITS // blocks) * (blocks - distance)
        return comb(blocks, distance) * (1 + prints / 2**key_bits)

    return min(range(distance + 1, distance + MOST_BLOCKS - 3), key=cost)


def group_links(prints: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Edges that connect what is linked within one set: each fingerprint leaves the pool when first reached, so every
    pair is compared once at most and a set gives fewer edges than it has members."""
    rest = np.unique(prints)
    a, b = [], []
    while len(rest):
        seed, rest = rest[0], rest[1:]
        frontier = [seed]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= distance
            if near.any():
                found = rest[near]
                rest = rest[~near]
                a += [seed] * len(found)
                b += found.tolist()
                frontier += list(found)
    return a, b


def _runs(distance: int):
    """Scan rows sorted by (bucket, cell); the last bucket of a batch waits for the next batch."""

    def compare(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(prints)))
        run = np.repeat(np.arange(len(starts)), sizes)
        a, b = [], []
        small = np.repeat(sizes <= SMALL, sizes)
        p, r = prints[small], run[small]
        for shift in range(1, min(SMALL, int(sizes.max()))):
            near = (r[shift:] == r[:-shift]) & (np.bitwise_count(p[shift:] ^ p[:-shift]) <= distance)
            a.append(p[:-shift][near])
            b.append(p[shift:][near])
        for i in np.flatnonzero(sizes > SMALL):
            x, y = group_links(prints[starts[i]:starts[i] + sizes[i]], distance)
            a.append(np.array(x, np.uint64))
            b.append(np.array(y, np.uint64))
        a, b = np.concatenate([*a, np.empty(0, np.uint64)]), np.concatenate([*b, np.empty(0, np.uint64)])
        return a[a != b], b[a != b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((4, 0), np.int64)
        for batch in batches:
            rows = np.concatenate((held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])), axis=1)
            if not rows.shape[1]:
                continue
            same = (rows[:3] == rows[:3, -1:]).all(axis=0)
            done, held = rows[:, ~same], rows[:, same]
            if done.shape[1]:
                yield out(*compare(done[:3], done[3].view(np.uint64)))
        if held.shape[1]:
            yield out(*compare(held[:3], held[3].copy().view(np.uint64)))

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def print_links(prints: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fingerprint``, staged) that connect all within ``distance``
    bits of each other: a spanning set per bucket and cell, not all pairs.

    A bucket holds the fingerprints equal under one mask. Buckets of one drop out before any comparison. A bucket
    larger than a cell is dealt in parts, and every two parts meet in one cell, so no task holds more than two parts.
    """
    masks = block_masks(choose_blocks(prints.count(), distance), distance)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keyed = prints.select("fingerprint", F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in signed])).alias("mask", "key"))
    shared = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = keyed.join(shared, ["mask", "key"]).withColumn("parts", F.ceil(F.col("n") / CELL).cast("int"))
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    cell = lambda other: F.least(F.col("part"), other) * F.col("parts") + F.greatest(F.col("part"), other)
    dealt = rows.withColumn("part", part).select("mask", "key", F.explode(F.transform(others, cell)).alias("cell"), "fingerprint")
    dealt = dealt.repartition("mask", "key", "cell").sortWithinPartitions("mask", "key", "cell")
    found = dealt.mapInArrow(_runs(distance), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the edges (a, b), a < b.

    Rounds of large-star and small-star until every edge leads to a root. Minima come from partial aggregation and
    go back by joins, so a node with very many neighbours is never gathered in one place.
    """
    edges = stage(edges, name)

    def stars(rows, larger):
        both = rows.union(rows.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else rows.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        if larger:  # neighbours above the node go to its least neighbour
            moved = joined.where("b > a").select("m", "b")
        else:  # the node and its lesser neighbours go to the least of them
            moved = joined.select("m", "b").union(least.select("m", F.col("a").alias("b")))
        return moved.where("m <> b").select(F.col("m").alias("a"), "b").distinct()

    while True:
        edges = stage(stars(stage(stars(edges, True), name), False), name)
        roots = edges.select(F.col("a").alias("b")).distinct()
        if edges.join(roots, "b", "left_semi").isEmpty() and edges.groupBy("b").count().where("count > 1").isEmpty():
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: two rows are linked if their SimHash fingerprints differ in at
    most ``distance`` bits, and ``component_id`` is the smallest ``doc_id`` reachable over links.

    Null, empty and blank texts have fingerprint zero and are linked like others. Rows without a ``doc_id`` give and
    take links, but are never the id of a component; it is null if no row of the component has one. Repeated rows give
    repeated results. Work after the scan is on distinct fingerprints, so exact copies cost one row; the class goes back
    to the rows of a fingerprint with very many copies by broadcast (``join_counted``).
    """
    found = stage(fingerprints(docs, words, doc_id, text), "fingerprints")
    prints = stage(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "prints")
    roots = components(print_links(prints, distance))
    named = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = stage(named.withColumn("root", F.coalesce("root", "fingerprint")), "roots")
    least = stage(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")), "components")
    classes = join_counted(named, least, ["root"], named.count()).select("fingerprint", "component_id", F.col("copies").alias("n"))
    return join_counted(found, stage(classes, "classes"), ["fingerprint"], found.count()).select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest ``doc_id`` of each component, with all its columns; rows that repeat this
    ``doc_id`` are that document and stay. Rows without a ``doc_id`` stay only where their whole component has none."""
    found = near_duplicates(docs, words, distance, doc_id, text)
    gone = found.where("not (doc_id <=> component_id)").select("doc_id").distinct()
    key, = spare(docs, "gone_id")
    return docs.join(gone.withColumnRenamed("doc_id", key), quoted(doc_id).eqNullSafe(F.col(key)), "left_anti")
