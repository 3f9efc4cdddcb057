"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, then exact shingle similarity."""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import quoted
from shelfmatch.llm.hashing import STEP, mixed, piece_hashes

BITS = 64
BLOCK_BITS = 16
BLOCK_SHINGLES = 200_000  # of benchmark items that are sent to the tasks at a time
PIECE_BYTES = 1 << 20  # of one text that are looked at together
WINDOWS = 1 << 13  # fingerprinted at a time

_IS_WORD = np.array([chr(b).isalnum() or b >= 128 for b in range(128)] + [True] * 128)
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


@dataclass
class Words:
    """The words (runs of letters and digits; bytes of other scripts count as letters) of lower-case UTF-8."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.hashes)

    def bag(self, first: int, n: int, width: int) -> Counter:
        """The shingles from a word on, letter by letter, and how often each occurs."""
        words = [self.data[a:b] for a, b in zip(self.starts[first:first + n + width - 1].tolist(), self.ends[first:first + n + width - 1].tolist())]
        return Counter(b" ".join(words[i:i + width]) for i in range(n))


def words_of(data: bytes) -> Words:
    raw = np.frombuffer(data, np.uint8)
    inside = _IS_WORD[raw]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return Words(data, edge[::2], edge[1::2], piece_hashes(raw, edge[::2], edge[1::2]))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash per run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = total * STEP + words[i:i + n]
    return mixed(total)


def bit_rows(hashes: np.ndarray) -> np.ndarray:
    """(n, 64) of 0 and 1."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, BITS // 8), axis=1)


def pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def window_prints(running: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """SimHash of ``n`` shingles from each start, from running sums of bits: a bit is set if most shingles have it."""
    return pack((running[starts + n] - running[starts]) * 2 > n)


def near_values(block: int, within: int, bits: int = BLOCK_BITS) -> np.ndarray:
    """All values of a block that differ from ``block`` in at most ``within`` bits."""
    every = np.arange(1 << bits, dtype=np.uint32)
    return every[np.bitwise_count(every ^ np.uint32(block)) <= within]


@dataclass
class Size:
    """The items of one number of words, and for each block of the fingerprint which values may belong to one."""

    words: int
    width: int
    items: list[int]
    prints: np.ndarray
    tables: np.ndarray  # (blocks, 2^16): whether a window with this value can be within the radius

    @property
    def shingles(self) -> int:
        return self.words - self.width + 1


@dataclass
class Index:
    """What the tasks need of a block of items. Its size follows from the bound on shingles."""

    sizes: list[Size]
    known: np.ndarray  # sorted distinct shingle hashes of all items
    counts: dict[int, tuple[np.ndarray, np.ndarray]]  # item: the hashes of its shingles and how often each occurs
    bags: dict[int, Counter]  # item: its shingles, letter by letter
    radius: int
    similarity: float


def build_index(items: list[tuple[int, str]], width: int, radius: int, similarity: float) -> Index:
    by_words = defaultdict(list)
    counts, bags = {}, {}
    for item, text in items:
        words = words_of(text.lower().encode())
        if len(words):
            own = shingle_hashes(words.hashes, min(width, len(words)))
            counts[item] = np.unique(own, return_counts=True)
            bags[item] = words.bag(0, len(own), min(width, len(words)))
            by_words[len(words)].append((item, own))
    sizes = []
    blocks = BITS // BLOCK_BITS
    for n, members in sorted(by_words.items()):
        prints = np.concatenate([pack(bit_rows(own).sum(axis=0, dtype=np.int32)[None, :] * 2 > len(own)) for _, own in members])
        tables = np.zeros((blocks, 1 << BLOCK_BITS), bool)
        for value in prints.tolist():
            for k in range(blocks):
                tables[k, near_values(value >> (BLOCK_BITS * k) & 0xFFFF, radius // blocks)] = True
        sizes.append(Size(n, min(width, n), [m[0] for m in members], prints, np.packbits(tables, axis=1)))
    known = np.unique(np.concatenate([own for own, _ in counts.values()] or [np.empty(0, np.uint64)]))
    return Index(sizes, known, counts, bags, radius, similarity)


def at_most(window: np.ndarray, item: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two bags of hashes: sum of lesser counts over sum of greater counts. Shingles that share a
    hash can only raise it."""
    own, times = np.unique(window, return_counts=True)
    at = np.searchsorted(item[0], own).clip(max=len(item[0]) - 1)
    both = np.minimum(times, item[1][at])[item[0][at] == own].sum()
    return float(both / (len(window) + item[1].sum() - both))


def similar(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of two bags of shingles."""
    both = (a & b).total()
    return both / (a.total() + b.total() - both)


def matches(words: Words, index: Index, tables: list[np.ndarray], whole: bool) -> dict[int, tuple[float, int]]:
    """Item: best similarity of a window and the word at which that window starts. If ``words`` are the ``whole`` text,
    they are also compared with the items of more words, as one window and without fingerprints."""
    found: dict[int, tuple[float, int]] = {}
    by_width: dict[int, tuple] = {}

    def verify(item: int, size: Size, first: int, n: int) -> None:
        value = at_most(by_width[size.width][0][first:first + n], index.counts[item])
        if value >= index.similarity and value > found.get(item, (0.0, 0))[0]:
            value = similar(words.bag(first, n, size.width), index.bags[item])
            if value >= index.similarity and value > found.get(item, (0.0, 0))[0]:
                found[item] = (value, first)

    for size, table in zip(index.sizes, tables, strict=True):
        short = len(words) < size.words
        if short and (not whole or len(words) - size.width + 1 < index.similarity * size.shingles):  # too few to be as similar
            continue
        if size.width not in by_width:
            hashes = shingle_hashes(words.hashes, size.width)
            at = np.searchsorted(index.known, hashes).clip(max=len(index.known) - 1)
            hits = index.known[at] == hashes
            by_width[size.width] = (hashes, np.concatenate(([0], np.cumsum(hits))), None)
        hashes, hits, running = by_width[size.width]
        if not hits[-1]:
            continue
        if short:
            for item in size.items:
                verify(item, size, 0, len(hashes))
            continue
        n = size.shingles
        starts = np.flatnonzero(hits[n:] > hits[:-n])  # a window without any shingle of the benchmark has similarity 0
        if not len(starts):
            continue
        if running is None:
            running = np.zeros((len(hashes) + 1, BITS), np.int32)
            np.cumsum(bit_rows(hashes), axis=0, dtype=np.int32, out=running[1:])
            by_width[size.width] = (hashes, hits, running)
        prints = np.concatenate([window_prints(running, starts[i:i + WINDOWS], n) for i in range(0, len(starts), WINDOWS)])
        maybe = np.zeros(len(prints), bool)
        for k in range(BITS // BLOCK_BITS):
            maybe |= table[k][(prints >> np.uint64(BLOCK_BITS * k) & np.uint64(0xFFFF)).astype(np.int64)]
        starts, prints = starts[maybe], prints[maybe]
        for item, own in zip(size.items, size.prints):
            for s in starts[np.bitwise_count(prints ^ own) <= index.radius].tolist():
                verify(item, size, s, n)
    return found


def text_pieces(text: str, longest: int) -> Iterator[tuple[int, Words, bool]]:
    """(number of the first word, words, whether they are all) of the whole text, in pieces that overlap by ``longest``
    words less one. A text of fewer words than that ends as one piece."""
    data = text.lower().encode()
    first, at, end = 0, 0, 0
    while True:
        end = min(len(data), end + PIECE_BYTES)
        gap = _GAP.search(data, end)  # never inside a word
        end = gap.start() if gap else len(data)
        words = words_of(data[at:end])
        yield first, words, at == 0 and end == len(data)
        if end == len(data):
            return
        over = len(words) - (longest - 1)
        if over > 0:
            at = at + int(words.starts[over]) if longest > 1 else end
            first += over


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of bounded size. Each block is read by a job of its own; one item is never in two."""
    words = F.size(F.split(F.coalesce(quoted(text), F.lit("")), r"\s+")).cast("long")
    items = benchmark.select(quoted(item_id).cast("long").alias("item"), quoted(text).alias("text"), words.alias("n")).where("text is not null")
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // BLOCK_SHINGLES)
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).select("item", "text").distinct()
        yield [tuple(r) for r in mine.toLocalIterator()]


def _matcher(items: list[tuple[int, str]], width: int, similarity: float, radius: int):
    """A column function: array of (item_id, similarity, first_word) of the items that a text holds."""
    ids = [item for item, _ in items]
    index = build_index([(k, text) for k, (_, text) in enumerate(items)], width, radius, similarity)
    longest = max([s.words for s in index.sizes], default=1)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())]))

    def held(text: str, tables: list[np.ndarray]) -> list[dict]:
        best: dict[int | None, tuple[float, int]] = {}
        for first, words, whole in text_pieces(text, longest):
            for k, (value, at) in matches(words, index, tables, whole).items():
                if value > best.get(ids[k], (0.0, 0))[0]:
                    best[ids[k]] = (value, first + at)
        return [{"item_id": i, "similarity": v, "first_word": at} for i, (v, at) in sorted(best.items(), key=lambda x: (x[0] is not None, x[0]))]

    @F.arrow_udf("array<struct<item_id: long, similarity: double, first_word: long>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = [np.unpackbits(s.tables, axis=1).astype(bool) for s in index.sizes]
        for texts in batches:
            yield pa.array([held(t.as_py() or "", tables) for t in texts], kind)

    return run


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = 23,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word) for every document that holds a benchmark item: some window of as many
    words as the item (the whole text, if it has fewer) has weighted Jaccard ``similarity`` or more with it, on bags of
    ``width``-word shingles.

    Words are runs of letters and digits in lower case. Items of fewer words are one shingle. Windows at every word are
    fingerprinted, but for windows that share no shingle with any item, whose similarity is 0. The 64 bits are split in
    four blocks; a fingerprint within ``radius`` bits of an item's differs from it in at most ``radius // 4`` bits of
    some block, so tables of those values miss none. What is left is compared exactly, word by word. A window at the
    least similarity is expected to differ in 10 of 64 bits; README has how many such windows the radius loses.

    Null, empty and blank texts and items match nothing. Items of one id are all tried, and the best counts (ties: the
    first window); those without id are one item with a null id. Repeated documents give repeated rows. Texts of any
    length are read whole, in pieces. Other columns of both tables are left out, whatever their names. Without items
    the result is empty.

    The benchmark is a stated query set: it goes to the tasks in blocks of about ``BLOCK_SHINGLES`` words, with one
    scan of the documents per block; nothing of the documents is shuffled.
    """
    parts = []
    for items in benchmark_blocks(benchmark, item_id, item_text):
        run = _matcher(items, width, similarity, radius)
        found = docs.select(quoted(doc_id).cast("long").alias("doc_id"), F.explode(run(quoted(text))).alias("held"))
        parts.append(found.select("doc_id", "held.*"))
    if not parts:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, first_word long")
    return reduce(DataFrame.union, parts)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = 23,
    text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item (see ``find_contamination``), decided row by row in the
    scan. Null and empty texts stay."""
    for items in benchmark_blocks(benchmark, item_id, item_text):
        run = _matcher(items, width, similarity, radius)
        docs = docs.where(F.size(run(quoted(text))) == 0)
    return docs
