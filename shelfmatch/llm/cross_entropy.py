"""LM scoring by cross-entropy difference: matched target and background bigram models over the whole vocabulary."""

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import quoted, text_blocks
from shelfmatch.llm.hashing import STEP, mixed
from shelfmatch.sources.staging import broadcast_if_small, stage

LONGEST_TOKEN = 40  # characters; with a stated vocabulary size, longer ones are <unk>
PRIOR = 50.0  # how many tokens after a context the unigram model is worth
BATCH_WORDS = 200_000  # distinct words a task holds before it passes their counts on, or forgets their numbers
TEXT_BYTES = 8_000_000  # that a task numbers at a time
DEAL_BYTES = 2_000_000  # that a task takes apart into pairs at a time
SAMPLE_ROWS = 8192  # about, of which the most frequent pairs become common ones
COMMON_PAIRS = 1 << 17  # at most; counted and scored where the texts are read. Which they are changes the cost only
BUCKET_TOKENS = 1 << 21  # about, of the other pairs that are looked at together
KNOWN_WORDS = 1 << 20  # a word of more than this part of all tokens is known to every task, so fewer words than this are
TEXTS_TOGETHER = 20_000  # about, whose sums are added up by one task
UNKNOWN, START = 0, 1

_TOKEN = re.compile(r"\w+|[^\w\s]")


def tokens(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, and single other signs, in lower case."""
    return _TOKEN.findall((text or "").lower())


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, n) over all rows, summed within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                count.update(tokens(value.as_py()))
                if len(count) > BATCH_WORDS:
                    yield out(count)
                    count = Counter()
        if count:
            yield out(count)

    def out(count):
        kept = [(w, n) for w, n in count.items() if len(w) <= LONGEST_TOKEN]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    return docs.select(quoted(text)).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learn_vocabulary(docs: DataFrame, text: str, size: int) -> dict[str, int]:
    """Numbers for the most frequent tokens of all texts (equal counts: by spelling); 0 is <unk>, 1 the start."""
    top = stage(count_words(docs, text).orderBy(F.desc("n"), "word").limit(size - 2), "words")  # merged by a task
    return {r.word: i + 2 for i, r in enumerate(sorted(top.collect(), key=lambda r: (-r.n, r.word)))}


class Numbers(dict):
    """Word: its 64-bit hash, or 0 if a stated vocabulary has no such word."""

    def __init__(self, vocabulary: dict[str, int] | None):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        known = self.vocabulary is None or word in self.vocabulary
        self[word] = found = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) if known else UNKNOWN
        return found


@dataclass
class Block:
    """The pairs (token before, token) of some texts, one after the other."""

    first: np.ndarray
    second: np.ndarray
    text: np.ndarray  # which text
    ends: np.ndarray  # the last token of its text, which is before no other
    lengths: np.ndarray  # tokens of each text

    @property
    def keys(self) -> np.ndarray:
        return pair_keys(self.first, self.second)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(mixed(first.view(np.uint64)) * STEP + second.view(np.uint64))


def numbered(texts: list[str | None], numbers: Numbers) -> Block:
    parts = []
    for text in texts:
        found = tokens(text)
        parts.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
        if len(numbers) > BATCH_WORDS:
            numbers.clear()
    lengths = np.array([len(p) for p in parts], np.int64)
    second = np.concatenate([*parts, np.empty(0, np.int64)])
    stops = np.cumsum(lengths)[lengths > 0]
    ends = np.zeros(len(second), bool)
    ends[stops - 1] = True
    first = np.roll(second, 1)
    first[np.concatenate(([0], stops[:-1])) if len(stops) else stops] = START
    return Block(first, second, np.repeat(np.arange(len(parts)), lengths), ends, lengths)


def found_at(known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted ``known``, whether it is there) of each value."""
    if not len(known):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.searchsorted(known, values).clip(max=len(known) - 1)
    return at, known[at] == values


def common_pairs(sample: DataFrame, vocabulary: dict[str, int] | None) -> tuple[np.ndarray, np.ndarray]:
    """(first, second) of the most frequent pairs of some texts, in the order of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(vocabulary)
        for batch in text_blocks(batches, 0, TEXT_BYTES):
            block = numbered(batch.column(0).to_pylist(), numbers)
            _, at, n = np.unique(block.keys, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(block.first[at]), pa.array(block.second[at]), pa.array(n)], ["first", "second", "n"])

    counted = sample.select("text").mapInArrow(run, "first long, second long, n long").groupBy("first", "second").agg(F.sum("n").alias("n")).where("n > 1")
    top = stage(counted.orderBy(F.desc("n"), "first", "second").limit(COMMON_PAIRS), "common-pairs").toArrow()
    first, second = (top.column(c).to_numpy().astype(np.int64) for c in ("first", "second"))
    keys, at = np.unique(pair_keys(first, second), return_index=True)
    return first[at], second[at]


def count_tokens(marked: DataFrame, vocabulary: dict[str, int] | None, common: np.ndarray) -> DataFrame:
    """(pair, key, background, target, background_before, target_before), staged. For every word: how often it occurs in
    all and in target texts, and how often before another word. For every common pair (``key`` is its place): how often
    it occurs."""
    names = ["background", "target", "background_before", "target_before"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(vocabulary)
        pairs = np.zeros((2, len(common)), np.int64)
        for batch in text_blocks(batches, 0, TEXT_BYTES):
            block = numbered(batch.column(0).to_pylist(), numbers)
            target = np.array(batch.column(1).to_pylist(), bool)[block.text]
            words, place = np.unique(block.second, return_inverse=True)
            yield out(False, words, [np.bincount(place[kept], minlength=len(words)) for kept in (slice(None), target, ~block.ends, target & ~block.ends)])
            at, hit = found_at(common, block.keys)
            pairs[0] += np.bincount(at[hit], minlength=len(common))
            pairs[1] += np.bincount(at[hit & target], minlength=len(common))
        seen = np.flatnonzero(pairs[0])
        yield out(True, seen, [pairs[0, seen], pairs[1, seen], np.zeros(len(seen), np.int64), np.zeros(len(seen), np.int64)])

    def out(pair, keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), pair)), pa.array(keys.astype(np.int64)), *[pa.array(c.astype(np.int64)) for c in counts]], ["pair", "key", *names])

    parts = marked.select("text", "target").mapInArrow(run, "pair boolean, key long, " + ", ".join(f"{n} long" for n in names))
    return stage(parts.groupBy("pair", "key").agg(*[F.sum(n).alias(n) for n in names]), "token-counts")


@dataclass
class Models:
    """Sizes of both models (background, target), and the counts of common words and pairs.

    Matched: the background's counts are scaled to the size of the target's, so that the same prior smooths both
    alike. A context's counts are filled up by ``PRIOR`` tokens of the unigram model, which itself gets one of each.
    """

    sizes: np.ndarray
    texts: np.ndarray  # with tokens: how often the start stands before a word
    vocabulary: int
    words: np.ndarray  # sorted
    occur: np.ndarray  # (2, words)
    before: np.ndarray
    pairs: np.ndarray  # sorted keys
    pair_losses: np.ndarray  # (2, pairs), see ``loss_of``

    @property
    def scale(self) -> np.ndarray:
        both = self.sizes[0] > 0 and self.sizes[1] > 0
        return np.array([self.sizes[1] / self.sizes[0] if both else 1.0, 1.0])[:, None]

    def loss_of(self, pair_counts: np.ndarray, word_counts: np.ndarray) -> np.ndarray:
        """-log of the smoothed count of each pair (its loss less what ``before_of`` the token before gives)."""
        single = (word_counts * self.scale + 1) / (self.sizes[:, None] * self.scale + self.vocabulary)
        return -np.log(pair_counts * self.scale + PRIOR * single)

    def before_of(self, counts: np.ndarray) -> np.ndarray:
        """log of the smoothed count of a token before any other."""
        return np.log(counts * self.scale + PRIOR)


def learn_models(counted: DataFrame, first: np.ndarray, second: np.ndarray, vocabulary_size: int | None) -> Models:
    names = ["background", "target"]
    words = counted.where("not pair")
    sums = words.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(n), F.lit(0)) for n in (*names, *[f"{n}_before" for n in names])]).first()
    sizes = np.array(sums[1:3], float)
    wanted = counted.sparkSession.createDataFrame(pa.table({"key": np.unique(np.concatenate((first, second)))}))
    held = words.join(F.broadcast(wanted), "key", "left_semi").unionByName(words.where(F.col("background") * KNOWN_WORDS > int(sums[1])))
    held = held.drop("pair").distinct().orderBy("key").toArrow()
    occur, before = (np.array([held.column(n + end).to_numpy() for n in names], float).reshape(2, -1) for end in ("", "_before"))
    own = counted.where("pair").select("key", *names).toArrow()
    pair_counts = np.zeros((2, len(first)))
    pair_counts[:, own.column("key").to_numpy()] = [own.column(n).to_numpy() for n in names]
    models = Models(sizes, sizes - sums[3:5], vocabulary_size or sums[0] + 2, held.column("key").to_numpy().astype(np.int64), occur, before, pair_keys(first, second), np.empty((2, 0)))
    at, _ = found_at(models.words, second)
    models.pair_losses = models.loss_of(pair_counts, occur[:, at])
    return models


_ENTRY = [("first", np.int64), ("second", np.int64), ("row", np.int64), ("n", np.int32), ("before", np.int32), ("target", np.int8)]
_SUM = [("row", np.int64), ("background", np.float64), ("target", np.float64)]


def pack(columns: list[np.ndarray], kinds: list = _ENTRY) -> bytes:
    return b"".join(c.astype(kind).tobytes() for c, (_, kind) in zip(columns, kinds))


def unpack(data: list[bytes], kinds: list = _ENTRY) -> list[np.ndarray]:
    """The columns of all packed entries."""
    width = sum(np.dtype(kind).itemsize for _, kind in kinds)
    parts: list[list[np.ndarray]] = [[np.empty(0, kind)] for _, kind in kinds]
    for content in data:
        n, at = len(content) // width, 0
        for held, (_, kind) in zip(parts, kinds):
            held.append(np.frombuffer(content, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) for p in parts]


def score_documents(docs: DataFrame, target_ids: DataFrame, vocabulary_size: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row: mean losses per token under the model of
    the target documents (rows whose ``doc_id`` is in ``target_ids``, a single column) and under that of all
    documents; ``score`` is the mean of their differences, below 0 for texts more like the target.

    Every word of the corpus is in the vocabulary and every pair of words is counted. With ``vocabulary_size``, all but
    the most frequent words (and the start of a text) are one word, <unk>.

    Texts without tokens (null, empty, blank) have 0 tokens and null losses. Rows without a ``doc_id`` belong to the
    background. Repeated rows count as often as they occur. Without target rows the target model is even, without
    rows the result is empty.

    Words are 64-bit hashes. Those of all texts are counted in a staged table, along with at most ``COMMON_PAIRS`` pairs
    that are frequent in a sample: these pairs, their words and very common words are known to every task. Each other
    pair goes, with its number in each text, to a bucket of its second word (of both, if the second is known). There
    it meets all its other occurrences and all those of an unknown second word, so the bucket has their counts and
    gives each text its sum of losses. These sums travel packed, one row for each bucket and group of texts, and are
    added up there. What is shuffled grows with the corpus, what the driver holds does not. A bucket has about
    ``BUCKET_TOKENS`` entries and those of one unknown word, at most one ``KNOWN_WORDS``-th of all tokens.

    A target text is part of both models, so its own rare words make it look a little more like the target. Other
    columns of both tables are left out, whatever their names. Equal texts get equal scores.
    """
    source = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    ids = target_ids.toDF("target_id").where("target_id is not null").distinct()
    ids = broadcast_if_small(stage(ids, "targets")).withColumn("target", F.lit(True))
    vocabulary = None if vocabulary_size is None else learn_vocabulary(source, "text", vocabulary_size)
    marked = source.join(ids, source.doc_id == ids.target_id, "left").select("text", F.coalesce("target", F.lit(False)).alias("target"), "row", "doc_id")
    rows = source.count()
    groups = np.uint64(max(1, rows // TEXTS_TOGETHER))
    sample = source.where(F.pmod(F.xxhash64("row"), F.lit(max(1, rows))) < SAMPLE_ROWS)
    first, second = common_pairs(sample, vocabulary)
    counted = count_tokens(marked, vocabulary, pair_keys(first, second))
    models = learn_models(counted, first, second, vocabulary_size)
    buckets = max(1, int(models.sizes[0]) // BUCKET_TOKENS)
    kind = f"row long, doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens long, background_loss double, target_loss double"
    names = ["row", "doc_id", "n_tokens", "background_loss", "target_loss"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(vocabulary)
        word_before, start = models.before_of(models.before), models.before_of(models.texts[:, None])
        for batch in text_blocks(batches, 0, DEAL_BYTES):
            block = numbered(batch.column(0).to_pylist(), numbers)
            target, rows = np.array(batch.column(1).to_pylist(), bool), batch.column(2).to_numpy()
            keys = block.keys
            at, common = found_at(models.pairs, keys)
            place, known = found_at(models.words, block.second)
            inner = known & ~block.ends
            sums = np.zeros((2, len(rows)))
            for m in range(2):
                sums[m] = np.bincount(block.text[common], models.pair_losses[m, at[common]], len(rows))
                sums[m] += np.bincount(block.text[inner], word_before[m, place[inner]], len(rows)) + start[m] * (block.lengths > 0)
            yield pa.RecordBatch.from_arrays([pa.array(rows % buckets, pa.int32()), pa.nulls(len(rows), pa.binary()), batch.column(2), batch.column(3), pa.array(block.lengths), *map(pa.array, sums)], ["bucket", "data", *names])
            rest = np.flatnonzero(~common)
            if len(rest):
                _, one, same, n = np.unique(mixed(keys[rest] + block.text[rest].astype(np.uint64) * STEP), return_index=True, return_inverse=True, return_counts=True)
                before = np.bincount(same, ~(block.ends | known)[rest], len(n))
                one = rest[one]
                hashes = np.where(known[one], keys[one], mixed(block.second[one].view(np.uint64)))
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((block.text[one], bucket))
                texts = block.text[one]
                columns = [c[order] for c in (block.first[one], block.second[one], rows[texts], n, before, target[texts])]
                edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
                data = [pack([c[a:b] for c in columns]) for a, b in zip(edges, edges[1:])]
                empty = [pa.nulls(len(data), batch.schema.field(i).type) for i in (2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order][edges[:-1]], pa.int32()), pa.array(data, pa.binary()), *empty, pa.nulls(len(data), pa.int64()), *[pa.nulls(len(data), pa.float64())] * 2], ["bucket", "data", *names])

    def meet(rows: pa.Table) -> pa.Table:
        heads = rows.filter(rows.column("data").is_null())
        heads = heads.select(["data", *names]).add_column(0, "texts", pa.array(group_of(heads.column("row").to_numpy())))
        data = [bytes(x) for x in rows.column("data").drop_null().to_pylist()]
        if not data:
            return heads
        first, second, row, n, before, target = unpack(data)
        own = np.stack((n, n * target)).astype(float)
        _, pair = np.unique(pair_keys(first, second), return_inverse=True)
        place, known = found_at(models.words, second)
        words, word = np.unique(second, return_inverse=True)

        def summed(of, count, values):
            return np.stack([np.bincount(of, v, count)[of] for v in values])

        occur = summed(word, len(words), own)
        occur[:, known] = models.occur[:, place[known]]
        loss = n * models.loss_of(summed(pair, pair.max() + 1, own), occur)
        loss += before * models.before_of(summed(word, len(words), (before.astype(float), (before * target).astype(float))))
        texts, text = np.unique(row, return_inverse=True)
        sums = [np.bincount(text, x, len(texts)) for x in loss]
        group = group_of(texts)
        order = np.argsort(group, kind="stable")
        edges = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
        packed = [pack([c[order[a:b]] for c in (texts, *sums)], _SUM) for a, b in zip(edges, edges[1:])]
        empty = [pa.nulls(len(packed), heads.schema.field(n).type) for n in names]
        return pa.concat_tables([heads, pa.table([pa.array(group[order[edges[:-1]]]), pa.array(packed, pa.binary()), *empty], heads.schema.names)])

    def add_up(rows: pa.Table) -> pa.Table:
        heads = rows.filter(rows.column("data").is_null()).select(names).sort_by("row")
        row, *sums = unpack([bytes(x) for x in rows.column("data").drop_null().to_pylist()], _SUM)
        at = np.searchsorted(heads.column("row").to_numpy(), row)
        columns = [heads.column(n).to_numpy() + np.bincount(at, s, heads.num_rows) for n, s in zip(("background_loss", "target_loss"), sums)]
        return pa.table([heads.column("doc_id"), heads.column("n_tokens"), *map(pa.array, columns)], ["doc_id", "n_tokens", "background", "target"])

    def group_of(row: np.ndarray) -> np.ndarray:
        return (mixed(row.astype(np.uint64)) % groups).astype(np.int32)

    dealt = marked.mapInArrow(deal, f"bucket int, data binary, {kind}")
    parts = dealt.groupBy("bucket").applyInArrow(meet, f"texts int, data binary, {kind}")
    own = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens long, background double, target double"
    texts = parts.groupBy("texts").applyInArrow(add_up, own)
    means = [F.when(F.col("n_tokens") > 0, F.col(m) / F.col("n_tokens")).alias(f"{m}_loss") for m in ("target", "background")]
    return texts.select("doc_id", "n_tokens", *means).withColumn("score", F.col("target_loss") - F.col("background_loss"))
