"""Source divergence audit: how far apart the term distributions of sources are, over trees of term rows."""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.llm.common import quoted
from shelfmatch.sources.staging import broadcast_if_small, stage

SCALE = 1_000_000_000
HELD_TERMS = 400_000  # (group, term) pairs that a task counts before it passes the counts on
TREE_ITEMS = 200_000  # of the paths that go into one tree
TREE_PAIRS = 1_000_000  # pairs of node and ancestor looked at together
TASK_PATHS = 20_000  # paths of one task, about

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")  # A-Z, a-z and whatever is not ASCII


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of (lang, source, text) rows, summed within the task."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def out():
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), found in counts.items():
            # both counters have met the terms in the same order
            for column, values in zip(columns, ([lang] * len(found), [source] * len(found), found.keys(), found.values(), docs[lang, source].values())):
                column.extend(values)
        arrays = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()))]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

    held = 0
    for batch in batches:
        langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
        for lang, source, text in zip(langs, sources, texts):
            found = _TERM.findall((text.as_py() or b"").lower())  # bytes: A-Z only
            group = counts[lang, source]
            held -= len(group)
            group.update(found)
            held += len(group)
            docs[lang, source].update(iter(dict.fromkeys(found)))  # once a text, in order
            if held > HELD_TERMS:
                yield out()
                counts.clear()
                docs.clear()
                held = 0
    if counts:
        yield out()


def share(count: str, size: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 5) / (size + 5 * terms)) of three columns, exactly; 1 without terms."""
    wide = {c: f"cast({c} as decimal(18,0))" for c in (count, size, terms)}
    found = f"cast({SCALE} as decimal(10,0)) * ({wide[count]} + 5) div ({wide[size]} + 5 * {wide[terms]})"
    return F.expr(f"if({terms} = 0, 1L, 1 + {found})")


def tree_corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value) of sorted (lang, path, n) rows, where a path is the (rank, p, z) of the sources that have a
    term, in the order of the sources, and n the number of terms with this path: how much the sums of |p - z| on both
    sides miss |p - p|, for each pair of sources a < b."""
    for batch in batches:
        lengths = np.asarray(pa.compute.list_value_length(batch.column(1)), np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < len(lengths):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TREE_ITEMS, "right")))
            yield from corrections(batch.slice(start, stop - start))
            start = stop


def corrections(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The corrections of the tree of some sorted rows."""
    paths = rows.column(1)
    items = paths.flatten()
    rank, p, z = (np.asarray(items.field(k), np.int64) for k in range(3))
    langs = rows.column(0).dictionary_encode()
    lang = np.asarray(langs.indices, np.int64)
    times = np.asarray(rows.column(2), np.int64)
    lengths = np.asarray(pa.compute.list_value_length(paths), np.int64)
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(lengths)), lengths)
    depth = np.arange(len(row)) - starts[row]
    # An item is on the path of the row before up to the first one that differs; from there on it makes new nodes.
    before = np.where(row > 0, row - 1, 0)
    above = starts[before] + depth
    shared = (row > 0) & (depth < lengths[before]) & (lang[row] == lang[before])
    above = np.where(shared, above, 0)
    shared &= (rank[above] == rank) & (p[above] == p)
    differs = np.concatenate(([0], np.cumsum(~shared)))
    new = differs[np.arange(len(row)) + 1] > differs[starts[row]]
    # The node of an item is the last new one of its depth; its multiplicity sums the rows through it.
    order = np.argsort(depth, kind="stable")
    node = np.empty(len(row), np.int64)
    node[order] = np.maximum.accumulate(np.where(new[order], np.arange(len(row)), 0))
    node = order[node]
    through = np.zeros(len(row), np.int64)
    np.add.at(through, node, times[row])
    nodes = np.flatnonzero(new & (depth > 0))
    pairs = np.cumsum(depth[nodes])
    first = 0
    while first < len(nodes):
        last = max(first + 1, int(np.searchsorted(pairs, (pairs[first - 1] if first else 0) + TREE_PAIRS, "right")))
        some = nodes[first:last]
        b = np.repeat(some, depth[some])
        a = starts[row[b]] + np.arange(len(b)) - np.repeat(np.cumsum(depth[some]) - depth[some], depth[some])
        value = through[b] * (np.abs(p[a] - p[b]) - np.abs(p[a] - z[b]) - np.abs(z[a] - p[b]) + np.abs(z[a] - z[b]))
        ranks = int(rank.max()) + 1
        keys, at = np.unique((lang[row[b]] * ranks + rank[a]) * ranks + rank[b], return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, value)
        found = [langs.dictionary.take(pa.array(keys // ranks**2)), pa.array(keys // ranks % ranks), pa.array(keys % ranks), pa.array(sums)]
        yield pa.RecordBatch.from_arrays(found, ["lang", "a", "b", "value"])
        first = last


def audit_sources(docs: DataFrame, min_documents: int = 30, top_terms: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) that occurs.

    Terms are runs of letters (A-Z, in lower case, a-z) and characters beyond ASCII. Each lang keeps those in at least
    ``min_documents`` of its rows. A group gives each kept term the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)), N
    being its count of all kept terms and V their number. Part 'pair': the other sources of the lang with the summed
    distances of the shares. Part 'term': the ``top_terms`` terms of the source whose share is above that in the whole
    lang, with the difference. Ranks from 1 by value, greatest first, ties by item in UTF-8 order.

    Null text, lang and source count as ''. Rows are not told apart by an id: repeated rows count each. Sources without
    a kept term, and langs without any, still have pairs (value 0 without kept terms). Other columns are left out,
    whatever their names. Texts are read whole, in one pass. An empty table gives an empty result. All sums are exact
    (64-bit; the shares are divided as decimals).

    A pair's distance is what it is for terms that neither source has, corrected for the terms of one (running sums over
    the distinct shares of a source) and for those of both. The latter come from frequent-pattern trees: each kept term
    is the path of the sources that have it, in their order, with their shares; equal paths are collapsed, sorted paths
    share the nodes of their common beginnings, and a node meets each of its ancestors once for all terms through it.
    A task holds a tree of at most ``TREE_ITEMS`` items, or one path, and its corrections sum up with those of others.
    """
    rows = docs.select(*[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = rows.mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = summed.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held"))
    kept = stage(held.where(F.col("docs") >= min_documents).drop("docs"), "kept-terms")

    langs = kept.groupBy("lang").agg(F.sum("n_lang").alias("size_lang"), F.count(F.lit(1)).alias("terms"))
    own = kept.select("lang", F.explode("held").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("size"), F.count(F.lit(1)).alias("own_terms"))
    every = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    groups = stage(every.withColumn("zero", F.lit(0).cast("long")).withColumn("rank", place).withColumn("z", share("zero", "size", "terms")).drop("zero"), "groups")
    small = broadcast_if_small(groups)

    entries = kept.select("lang", "term", "n_lang", F.explode("held").alias("x")).select("lang", "term", "n_lang", "x.source", "x.n").join(small, ["lang", "source"])
    entries = stage(entries.withColumn("p", share("n", "size", "terms")).withColumn("q", share("n_lang", "size_lang", "terms")), "entries")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = over.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms)

    paths = entries.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("rank", "p", "z"))).alias("path"))
    collapsed = stage(paths.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("n")), "paths")
    begins = F.transform(F.slice("path", 1, 4), lambda x: F.shiftleft(x["rank"], 31) + x["p"])  # enough to part them, and short
    ordered = collapsed.repartitionByRange(max(1, collapsed.count() // TASK_PATHS), "lang", begins, F.xxhash64("path")).sortWithinPartitions("lang", "path")
    met = ordered.mapInArrow(tree_corrections, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    pairs = both_ways(one_sided(entries, groups).unionByName(met)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "rank", "source")
    named = pairs.join(broadcast_if_small(names.select("lang", F.col("rank").alias("a"), "source")), ["lang", "a"])
    named = named.join(broadcast_if_small(names.select("lang", F.col("rank").alias("b"), F.col("source").alias("item"))), ["lang", "b"])
    pairs = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(terms)


def one_sided(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for a <> b: over the terms of a the sum of |p - z of b| less |z of a - z of b|; for a < b also
    |z of a - z of b| times the number of kept terms.

    The distinct shares of a and the other sources' z are sorted together; running sums say how many shares are below
    each z. So a source costs its distinct shares plus the number of sources, not their product.
    """
    a = groups.select("lang", F.col("rank").alias("a"), F.col("z").alias("z_a"), "own_terms", "terms")
    b = groups.select("lang", F.col("rank").alias("b"), F.col("z").alias("at"))
    asked = a.join(b, "lang").where("a <> b").withColumn("n", F.lit(0).cast("long"))
    shares = entries.groupBy("lang", F.col("rank").alias("a"), F.col("p").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    together = asked.unionByName(shares, allowMissingColumns=True)
    so_far = Window.partitionBy("lang", "a").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = Window.partitionBy("lang", "a")
    weight = F.col("n") * F.col("at")
    summed = together.select(
        "*", F.sum("n").over(so_far).alias("n_below"), F.sum(F.when(F.col("b").isNull(), weight).otherwise(0)).over(so_far).alias("p_below"),
        F.sum(F.when(F.col("b").isNull(), weight).otherwise(0)).over(all_).alias("p_all")).where("b is not null")
    apart = F.abs(F.col("z_a") - F.col("at"))
    value = F.col("p_all") - F.col("own_terms") * (F.col("at") + apart) + 2 * (F.col("n_below") * F.col("at") - F.col("p_below"))
    value += F.when(F.col("a") < F.col("b"), apart * F.col("terms")).otherwise(0)
    return summed.select("lang", "a", "b", value.cast("long").alias("value"))


def both_ways(values: DataFrame) -> DataFrame:
    """Each value for (a, b) and for (b, a): one shuffle then sums all parts of a pair."""
    sides = F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("s")
    return values.select("lang", sides, "value").select("lang", "s.a", "s.b", "value")
