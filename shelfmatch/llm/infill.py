"""Fill-in-the-middle: each document is a piece table over its own text and the sentinels."""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfmatch.llm.common import map_rows, text_blocks, with_columns, without

TEXT, SENTINELS = 0, 1  # the two buffers; neither is ever changed
PREFIX, MIDDLE, SUFFIX = 0, 1, 2  # pieces of the text after two cuts; the pieces of the sentinels follow as 3, 4, 5
ORDERS = {"psm": (3, PREFIX, 4, SUFFIX, 5, MIDDLE), "spm": (4, SUFFIX, 3, PREFIX, 5, MIDDLE)}
PIECE = "array<struct<buffer:int,start:long,length:long>>"


class Rule(NamedTuple):
    """How documents are cut and arranged."""

    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle; none holds or overlaps another
    seed: str = "1:"  # stands before the id in what is hashed
    changed: int = 90  # of 100 documents, about; the others stay plain
    suffix_first: int = 20  # of 100 changed documents, about


def draws(rule: Rule, doc_id) -> list[int]:
    """Four numbers below 2**32 that only the seed and the id decide."""
    digits = hashlib.sha256(f"{rule.seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i:i + 8], 16) for i in range(0, 32, 8)]


def unit_starts(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the units of UTF-8 texts that follow each other begin: runs of A-Z and a-z, and single other characters."""
    letter = ((raw | 0x20) - np.uint8(97)) < 26
    first = (raw & 0xC0) != 0x80
    first[1:] &= ~(letter[1:] & letter[:-1])
    begins = ends[:-1][ends[:-1] < ends[1:]]
    first[begins] = True  # a run of letters ends with its text
    return np.flatnonzero(first)


def text_bytes(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts one after the other (null: nothing), and where each begins and the last ends."""
    data = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, 8 * data.offset)
    return bytes(data.buffers()[2][ends[0]:ends[-1]]) if ends[-1] > ends[0] else b"", ends - ends[0]


def cut(starts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split the last piece of every row at the given place: one more column of descriptors."""
    behind = starts[:, -1] + lengths[:, -1] - at
    return np.column_stack((starts, at)), np.column_stack((lengths[:, :-1], lengths[:, -1] - behind, behind))


def streamed(pieces: list[memoryview]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


def rearrange(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut each text twice at places that its id decides and put the middle last.

    Units are runs of A-Z and a-z and single other characters. Adds ``n`` (units), ``form`` ('plain', 'psm' or 'spm'),
    ``prefix_chars`` and ``middle_chars`` (code points; null if plain), ``pieces`` (buffer 0: the text, 1: the sentinels
    one after the other; start and length in UTF-8 bytes), ``output`` and ``output_sha256`` of its UTF-8 bytes.

    A null text counts as an empty one; empty texts and texts that hold a sentinel are plain. A null id is hashed as an
    empty one. Repeated rows give repeated rows. Columns named like those added are replaced, all others pass. An empty
    table gives an empty result. A text of any length is cut; a task holds about 2 MB of texts, or one text, at a time.

    The table of descriptors starts with one piece a text; a cut splits a descriptor, an arrangement permutes them.
    Texts are not copied before the output is written, and the hash reads the descriptors in their order.
    """
    docs = without(docs, "n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256")
    id_at, text_at = docs.columns.index(doc_id), docs.columns.index(text)
    marks = [s.encode() for s in rule.sentinels]
    mark_starts = np.cumsum([0, *map(len, marks)])[:3]
    mark_view = memoryview(b"".join(marks))
    added = T.StructType().add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long")
    added = added.add("pieces", T.DataType.fromDDL(PIECE)).add("output", "string").add("output_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, text_at):
            texts = batch.column(text_at)
            data, ends = text_bytes(texts)
            raw, view = np.frombuffer(data, np.uint8), memoryview(data)
            units = unit_starts(raw, ends)
            first = np.searchsorted(units, ends)
            n = np.diff(first)
            units = np.append(units, len(raw))
            chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            held = np.zeros(len(n), bool)
            for mark in rule.sentinels:
                held |= np.asarray(pc.fill_null(pc.match_substring(texts, mark), False))
            h = np.array([draws(rule, x.as_py()) for x in batch.column(id_at)], np.int64).reshape(-1, 4)
            plain = (n == 0) | held | (h[:, 2] % 100 >= rule.changed)
            after = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
            places = np.where(after < n[:, None], units[np.minimum(first[:-1, None] + after, len(units) - 1)], ends[1:, None])
            starts, lengths = ends[:-1, None], np.diff(ends)[:, None]
            for k in range(2):
                starts, lengths = cut(starts, lengths, places[:, k])
            sizes = chars[starts + lengths] - chars[starts]
            form = np.where(plain, "plain", np.where(h[:, 3] % 100 < rule.suffix_first, "spm", "psm"))
            pieces, output, digests = [], [], []
            for i, kind in enumerate(form.tolist()):
                if kind == "plain":
                    table = [(TEXT, int(ends[i]), int(ends[i + 1] - ends[i]))]
                else:
                    table = [(TEXT, int(s), int(m)) for s, m in zip(starts[i], lengths[i])]
                    table += [(SENTINELS, int(s), len(m)) for s, m in zip(mark_starts, marks)]
                    table = [table[k] for k in ORDERS[kind]]
                views = [(mark_view if b else view)[s:s + m] for b, s, m in table]
                digests.append(streamed(views))
                output.append(b"".join(views))
                pieces.append([{"buffer": b, "start": s if b else s - int(ends[i]), "length": m} for b, s, m in table])
            yield with_columns(batch, [
                pa.array(n), pa.array(form.tolist()), pa.array(sizes[:, PREFIX], mask=plain), pa.array(sizes[:, MIDDLE], mask=plain),
                pa.array(pieces, pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))),
                pa.array(output, pa.binary()).cast(pa.string()), pa.array(digests),
            ])

    return map_rows(docs, run, added)


def restore(docs: DataFrame, rule: Rule = Rule(), output: str = "output", form: str = "form") -> DataFrame:
    """The inverse of ``rearrange``, from the output and its form alone: adds ``restored`` and ``restored_sha256``.

    A null output gives null. Forms other than 'psm' and 'spm' are taken as plain. An output that lacks a sentinel its
    form asks for is an error. Columns of the added names are replaced.

    Pieces of the text lie between the sentinels, as none holds one; the inverse permutation puts them in order.
    """
    docs = without(docs, "restored", "restored_sha256")
    text_at, form_at = docs.columns.index(output), docs.columns.index(form)
    marks = [s.encode() for s in rule.sentinels]
    added = T.StructType().add("restored", "string").add("restored_sha256", "string")

    def pieces(data: bytes, kind: str) -> list[memoryview]:
        if kind not in ORDERS:
            return [memoryview(data)]
        order, at, found = ORDERS[kind], 0, {}
        for mark, piece in zip(order[::2], order[1::2]):
            begin = data.index(marks[mark - 3], at)
            if found:
                last = list(found)[-1]
                found[last] = (found[last], begin)
            elif begin:
                raise ValueError(f"text before the first sentinel of form {kind}")
            at = found[piece] = begin + len(marks[mark - 3])
        found[piece] = (at, len(data))
        return [memoryview(data)[slice(*found[k])] for k in (PREFIX, MIDDLE, SUFFIX)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, text_at):
            kinds = batch.column(form_at).to_pylist()
            whole = [None if x is None else pieces(x, kind) for x, kind in zip(batch.column(text_at).cast(pa.binary()).to_pylist(), kinds)]
            texts = pa.array([None if w is None else b"".join(w) for w in whole], pa.binary()).cast(pa.string())
            digests = pa.array([None if w is None else streamed(w) for w in whole], pa.string())
            yield with_columns(batch, [texts, digests])

    return map_rows(docs, run, added)
