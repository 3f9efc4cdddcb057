"""Byte-level BPE: encoding by a contiguous array of ranks per word, and decoding."""

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import quoted, without
from shelfmatch.llm.hashing import piece_hashes

# The word rules of byte-level pre-tokenization. In order: 's 't 're 've 'm 'll 'd, or a run of letters, of
# numbers or of other signs, each with one blank before it, or white space (less its last sign, if a word follows).
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
BLANK, APOSTROPHE = 32, 39
ENDINGS_1, ENDINGS_2 = "stmd", ("re", "ve", "ll")

SHORT = 100  # bytes of a word up to which ranks are scanned; longer words use a heap
BLOCK = 1 << 19  # characters that are encoded together
ROWS = 1 << 13  # words of one length that are merged together
SLOTS = 1 << 19  # of the cache of words in a Python worker
POOL = 1 << 22  # ids that the cache holds
PORTION = 256  # texts of an Arrow batch that are held as Python strings at a time
NO_RANK = 1 << 40  # the rank of a pair that does not merge

# Letters and numbers that Unicode got after version 16, which the rules to match do not know; the regex module may
LATER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 "
    "10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 "
    "16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 "
    "1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed "
    "1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)

_CUT = regex.compile(r"\P{White_Space}(?=\p{White_Space})")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def kinds_of_characters() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    kinds = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        kinds[code_points("".join(regex.findall(pattern, every)))] = kind
    for span in LATER.split():
        first, _, last = span.partition("-")
        kinds[int(first, 16):int(last or first, 16) + 1] = OTHER
    return kinds


def word_starts(points: np.ndarray, kinds: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the words of the texts begin that stand one after the other in ``points``, each from one of ``firsts``."""
    n = len(points)
    change = np.empty(n, bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[firsts] = True
    runs = np.flatnonzero(change)
    ends = np.append(runs[1:], n)
    last = np.zeros(n + 1, bool)
    last[firsts] = True
    last[n] = True  # where a text ends, the next begins
    white = kinds[runs] == SPACE
    start = np.zeros(n + 3, bool)
    start[runs[white]] = True
    start[ends[white & ~last[ends]] - 1] = True
    others = runs[~white]
    after_blank = (points[others - 1] == BLANK) & ~last[others] & (others > 0)
    start[others[~after_blank]] = True
    single = ~white & (ends - runs == 1)
    quote = runs[single & (points[runs] == APOSTROPHE)]
    quote = quote[start[quote] & ~last[quote + 1]]
    for length, endings in ((1, ENDINGS_1), (2, ENDINGS_2)):
        fits = np.zeros(len(quote), bool)
        for ending in endings:
            here = quote + length < n
            for k, letter in enumerate(ending):
                here &= points[np.minimum(quote + 1 + k, n - 1)] == ord(letter)
            fits |= here & (length == 1 or ~last[np.minimum(quote + 2, n)])
        start[quote[fits] + 1] = False
        start[quote[fits] + 1 + length] = True
    return np.flatnonzero(start[:n])


class Codec:
    """Vocabulary and merges of a byte-level BPE file (its JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, letters = spec["model"], byte_letters()
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if spec["normalizer"] or not plain.items() <= spec["pre_tokenizer"].items() or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE files without normalizer and prefix space can be read")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take white space or whole words only are not supported")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        vocab = model["vocab"]
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.kinds = kinds_of_characters()
        self.cached = np.zeros(SLOTS, np.uint64)
        self.place, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.pool, self.used = np.zeros(POOL, np.int32), 0
        self.letters_at, self.letters_of = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)  # the cached words: place, size
        self.letters, self.written = np.zeros(POOL, np.uint8), 0

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.order[at], NO_RANK)

    def merge(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(which words, their ids) of words of one length, a row each.

        A row holds the part behind each boundary, ``ranks`` the rank of each part with the next. In every row the
        first of the least ranks is merged, its boundary goes, and the two ranks beside it are looked up anew. Rows
        without a further merge leave, so all that stay have the same number of parts.
        """
        row, ranks = np.arange(len(ids)), self.ranks(ids[:, :-1], ids[:, 1:])
        while len(row) and ids.shape[1] > 1:
            n, every = ids.shape[1], np.arange(len(row))
            at = ranks.argmin(axis=1)
            best = ranks[every, at]
            if (done := best == NO_RANK).any():
                yield row[done], ids[done]
                stay = ~done
                ids, ranks, row, at, best = ids[stay], ranks[stay], row[stay], at[stay], best[stay]
                every = np.arange(len(row))
            column = np.arange(n - 1)
            ids[every, at] = self.merged[best]
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, column[:-1] + (column[:-1] >= at[:, None]), axis=1)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < n - 2)
            ranks[left, at[left] - 1] = self.ranks(ids[left, at[left] - 1], ids[left, at[left]])
            ranks[right, at[right]] = self.ranks(ids[right, at[right]], ids[right, at[right] + 1])
        if len(row):
            yield row, ids

    def long_word(self, data: np.ndarray) -> np.ndarray:
        """The same merges by a heap over linked parts, for words where scanning would take quadratic time."""
        ids = self.first[data].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < NO_RANK]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (q := int(self.ranks(np.array([ids[x]]), np.array([ids[y]]))[0])) < NO_RANK:
                    heapq.heappush(heap, (q, x, ids[x], ids[y]))
        return np.array([i for i in ids if i >= 0])

    def store(self, ids: np.ndarray) -> int:
        """Put ids into the pool; where they begin."""
        start = self.used
        if start + ids.size > len(self.pool):  # one block alone holds more
            self.pool = np.concatenate((self.pool, np.zeros(ids.size + POOL, np.int32)))
        self.pool[start:start + ids.size] = ids.ravel()
        self.used += ids.size
        return start

    def write(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keep the letters of words; where each begins."""
        ends = np.cumsum(sizes)
        places = self.written + ends - sizes
        total = int(ends[-1]) if len(ends) else 0
        if self.written + total > len(self.letters):
            self.letters = np.concatenate((self.letters, np.zeros(total + POOL, np.uint8)))
        self.letters[self.written:self.written + total] = raw[np.repeat(starts - ends + sizes, sizes) + np.arange(total)]
        self.written += total
        return places

    def differing(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, places: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Which words are not, letter by letter, those that are kept at ``places`` and have ``held`` letters. The words
        stand one after the other in ``raw`` without gaps."""
        wrong = sizes != held
        at = np.repeat(np.where(wrong, 0, places - starts), sizes) + np.arange(starts[0], starts[0] + sizes.sum())
        other = np.flatnonzero(self.letters.take(at, mode="clip") != raw[starts[0]:starts[0] + len(at)]) + starts[0]
        wrong[np.searchsorted(starts, other, "right") - 1] = True
        return np.flatnonzero(wrong)

    def encode_words(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the pool, number of ids) of each word raw[start:end]; the words stand one after the other.

        A cache holds the words seen last on each of its slots, found by a 64-bit hash. Every word is compared with the
        word whose ids it gets; those that only share the hash are encoded by themselves.
        """
        if max(self.used, self.written) > POOL // 2:
            self.cached[:], self.used, self.written = 0, 0, 0
        every = ends - starts
        hashes = piece_hashes(raw, starts, ends)
        slot = (hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        known = self.cached[slot] == hashes
        place, count = self.place[slot], self.count[slot]
        letters, held = self.letters_at[slot], self.letters_of[slot]
        fresh = np.flatnonzero(~known)
        _, one, which = np.unique(hashes[fresh], return_index=True, return_inverse=True)
        one = fresh[one]
        new_place, new_count = self.encode_apart(raw, starts[one], every[one])
        new_letters = self.write(raw, starts[one], every[one])
        place[fresh], count[fresh] = new_place[which], new_count[which]
        letters[fresh], held[fresh] = new_letters[which], every[one][which]
        self.cached[slot[one]], self.place[slot[one]], self.count[slot[one]] = hashes[one], new_place, new_count
        self.letters_at[slot[one]], self.letters_of[slot[one]] = new_letters, every[one]
        others = self.differing(raw, starts, every, letters, held)
        if len(others):
            place[others], count[others] = self.encode_apart(raw, starts[others], every[others])
        return place, count

    def encode_apart(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the pool, number of ids) of words that the cache does not have, those of one length together."""
        new_place, new_count = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        by_size = np.argsort(sizes, kind="stable")
        edges = np.flatnonzero(np.diff(sizes[by_size], prepend=-1, append=-1))
        for a, b in zip(edges, edges[1:]):
            size = sizes[by_size[a]]
            for at in range(a, b, ROWS):
                words = by_size[at:min(b, at + ROWS)]
                if size > SHORT:
                    groups = [(np.array([k]), self.long_word(raw[starts[w]:starts[w] + size])[None, :]) for k, w in enumerate(words)]
                else:
                    groups = self.merge(self.first[raw[starts[words][:, None] + np.arange(size)]])
                for rows, ids in groups:
                    new_place[words[rows]] = self.store(ids) + np.arange(len(rows)) * ids.shape[1]
                    new_count[words[rows]] = ids.shape[1]
        return new_place, new_count

    def encode_block(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; special tokens written in a text are ordinary words here."""
        lengths = np.array([len(t) for t in texts], np.int64)
        firsts = np.concatenate(([0], np.cumsum(lengths)))
        if not firsts[-1]:
            return [np.empty(0, np.int32) for _ in texts]
        whole = "".join(texts)
        points = code_points(whole)
        begins = word_starts(points, self.kinds[points], firsts[:-1][lengths > 0])
        bytes_before = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points >= 0x80) + (points >= 0x800).astype(np.int8) + (points >= 0x10000), out=bytes_before[1:])
        edges = bytes_before[np.append(begins, len(points))]
        place, count = self.encode_words(np.frombuffer(whole.encode(), np.uint8), edges[:-1], edges[1:])
        total = np.concatenate(([0], np.cumsum(count)))
        flat = self.pool[np.repeat(place - total[:-1], count) + np.arange(total[-1])]
        cuts = total[np.searchsorted(begins, firsts)]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def pieces(self, text: str) -> Iterator[str | int]:
        """A text as parts that can be encoded by themselves, and the ids of special tokens between them. Parts end at
        special tokens, and in a long text where white space follows something else."""
        for part in self.split.split(text) if any(s in text for s in self.special) else [text]:
            if part in self.special:
                yield self.special[part]
                continue
            at = 0
            while len(part) - at > BLOCK and (cut := _CUT.search(part, at + BLOCK)):
                yield part[at:cut.end()]
                at = cut.end()
            yield part[at:]

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each whole text."""
        held: list[tuple[int, str | int]] = []
        found: dict[int, list[np.ndarray]] = {}

        def flush():
            plain = [(k, p) for k, p in held if isinstance(p, str)]
            coded = iter(self.encode_block([p for _, p in plain]))
            for k, p in held:
                found.setdefault(k, []).append(next(coded) if isinstance(p, str) else np.array([p], np.int32))
            held.clear()

        size, given = 0, 0
        for k, text in enumerate(texts):
            for piece in self.pieces(text):
                held.append((k, piece))
                size += len(piece) if isinstance(piece, str) else 1
                if size >= BLOCK:
                    flush()
                    size = 0
            while given < k and (not held or given < held[0][0]):
                yield self.joined(found.pop(given))
                given += 1
        flush()
        for k in range(given, len(texts)):
            yield self.joined(found.pop(k))

    @staticmethod
    def joined(parts: list[np.ndarray]) -> np.ndarray:
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> str:
        """Unknown ids stand for nothing; bytes that are no UTF-8 become U+FFFD."""
        table = self.bytes_of
        if len(ids) and (ids.min() < 0 or ids.max() >= len(table)):
            ids = ids[(ids >= 0) & (ids < len(table))]
        return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


_CODECS: dict[bytes, Codec] = {}  # of this Python worker, kept with their words from task to task


def _codec(source: str) -> Codec:
    key = hashlib.sha256(source.encode()).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(source)
    return _CODECS[key]


def encode(docs: DataFrame, source: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array of token ids of every whole text. ``source`` is the JSON text of the vocabulary file.

    Null and empty texts give an empty array. Special tokens written in a text become their ids, no others are added.
    A column that is already named like ``ids`` is replaced. Rows stay as they are, repeated ones too.
    """

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        codec, parts = _codec(source), [pa.array([], pa.list_(pa.int32()))]
        for at in range(0, len(texts), PORTION):
            found = list(codec.encode_all([t or "" for t in texts.slice(at, PORTION).to_pylist()]))
            ends = np.cumsum([0, *map(len, found)])
            parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found))))
        return pa.concat_arrays(parts)

    return without(docs, ids).withColumn(ids, run(quoted(text))) if text != ids else docs.withColumn(ids, run(quoted(text)))


def decode(docs: DataFrame, source: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the text of the array column ``ids``. A null array gives an empty text; ids outside the vocabulary
    and null ids stand for nothing; bytes that are no UTF-8 become U+FFFD."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        codec, ends = _codec(source), lists.offsets.to_numpy()
        flat = pa.compute.fill_null(lists.values, -1).to_numpy(zero_copy_only=False)
        missing, parts = lists.is_null().to_pylist(), [pa.array([], pa.string())]
        for at in range(0, len(lists), PORTION):
            rows = range(at, min(len(lists), at + PORTION))
            parts.append(pa.array(["" if missing[i] else codec.decode(flat[ends[i]:ends[i + 1]]) for i in rows], pa.string()))
        return pa.concat_arrays(parts)

    return without(docs, decoded).withColumn(decoded, run(quoted(ids)))
