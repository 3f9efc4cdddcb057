"""WARC archives of Zstandard frames: one frame per record, the dictionary in a leading skippable frame."""

import base64
import hashlib
import struct
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import hash_sample, join_counted, quoted
from shelfmatch.sources.staging import stage

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D  # the skippable frame that holds the dictionary
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
RAW_DICTIONARY_MAGIC = 0xEC30A437
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"  # a skippable frame without content (magic 0x184D2A50), as text
VERSION = b"WARC/1.1"
RESPONSE_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64_000_000  # of payload per archive, about
DEALS = 8  # how many parts of an archive's size the rows of one id are dealt in
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 20_000, 64_000  # what the dictionary is trained on, and its size
LEVEL = 3
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, problem string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plan_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, last_by_digest) of the pages (page_id, payload) that repeat a payload of at least ``least_bytes``
    bytes: for each digest of such a payload, the largest ``page_id`` that has it, if that is another page.

    No payload is shuffled. The largest id per digest comes from partial aggregation and goes back to the digest's
    pages, by broadcast if there are very many (``join_counted``).
    """
    rows = pages.where("page_id is not null").where(F.octet_length("payload") >= least_bytes).select("page_id", F.sha2("payload", 256).alias("digest"))
    rows = stage(rows, "digests")
    shared = rows.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("first < last")
    repeats = join_counted(rows, stage(shared.drop("first"), "shared-digests"), ["digest"], rows.count()).where("page_id < last")
    return repeats.groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("digest", "last"))).alias("last_by_digest"))


def train_dictionary(samples: list[bytes]) -> bytes:
    """A Zstandard dictionary of a few sample payloads; empty (no dictionary) if they are too few or too small."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, at: str) -> bytes:
    """A WARC record. The block of a revisit is the HTTP head alone; ``X-Payload-Length`` says how long the payload is."""
    head = RESPONSE_HEAD % len(payload)
    block = head + payload if refers_to is None else head
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": at,
        "WARC-Target-URI": None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "X-Payload-Length": len(payload),
        "WARC-Profile": None if refers_to is None else PROFILE,
        "WARC-Refers-To": None if refers_to is None else f"<urn:page:{refers_to}>",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items() if v is not None)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, html: str = "html", page_id: str = "page_id", url: str = "url") -> None:
    """Write the pages as ``.warc.zst`` archives below ``path``: first a skippable frame with the dictionary, then one
    frame per record. Of pages with equal payloads of at least ``least_bytes`` bytes, that with the largest
    ``page_id`` is a response, the others are revisits of it; all other pages are responses, as are pages without id
    and repeated rows of the largest one.

    A null html is an empty payload; a null ``page_id`` leaves the number out of the record's id; a null url leaves
    out its field. Repeated rows are records each. An empty table gives archives without records. An archive holds
    about ``archive_bytes`` of payload at most, also if many rows have one ``page_id`` or none.

    Spark's text writer puts the frames into files, so any file system that Spark knows will do and a lost executor's
    half-written file never counts. Its line separator is an empty skippable frame, which every reader passes over.
    The dictionary is trained on at most ``SAMPLE_ROWS`` payloads, of the pages with the least hashes (their first ``SAMPLE_BYTES``).
    """
    source = pages.select(quoted(page_id).cast("long").alias("page_id"), quoted(url).alias("url"), F.encode(F.coalesce(quoted(html), F.lit("")), "UTF-8").alias("payload"))
    size, rows = source.agg(F.coalesce(F.sum(F.octet_length("payload") + 500), F.lit(0)), F.count(F.lit(1))).first()
    starts = source.select("page_id", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"))
    sample = hash_sample(starts, "page_id", "payload", rows, SAMPLE_ROWS)
    dictionary = train_dictionary([bytes(r.payload) for r in sample.collect()])
    at = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True)
        held = [dictionary_frame(dictionary)] if dictionary else []
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, refers_to = (c[i].as_py() for c in batch.columns)
                held.append(writer.compress(record_bytes(page, url, payload, refers_to, at)))
                if len(held[-1]) > 100_000 or len(held) >= 200:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])

    # at least as many as other shuffles have partitions: of fewer, the join would deal its rows once more
    archives = max(-(-size // archive_bytes), int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # rows of an id with many bytes are dealt in parts; such ids are at most DEALS times as many as full archives
    part = F.sum(F.octet_length("payload") + F.lit(500)) * DEALS / archive_bytes
    many = stage(source.where("page_id is not null").groupBy("page_id").agg(F.ceil(part).alias("parts")).where("parts > 1"), "many-rows")
    parts = F.coalesce("parts", F.lit(1))
    rows = source.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(many), "page_id", "left")
    rows = rows.withColumn("deal", F.coalesce("page_id", F.xxhash64("row"))).withColumn("part", F.pmod(F.xxhash64("row"), parts))  # pages without id are spread
    revisits = plan_revisits(source, least_bytes).join(F.broadcast(many), "page_id", "left")
    revisits = revisits.select(F.col("page_id").alias("deal"), "last_by_digest", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part")).repartition(archives, "deal", "part")
    dealt = rows.drop("parts", "row").repartition(archives, "deal", "part").join(revisits, ["deal", "part"], "left")
    refers_to = F.when(F.col("page_id").isNotNull(), F.try_element_at("last_by_digest", F.sha2("payload", 256))).alias("refers_to")
    frames = dealt.select("page_id", "url", "payload", refers_to).mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    frames.write.option("lineSep", EMPTY_FRAME).option("compression", "none").text(path)


def frames_of(content: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(magic number, the whole frame) of each frame of an archive."""
    at = 0
    while at < len(content):
        if len(content) - at < 8:
            raise ValueError("the archive ends inside a frame")
        magic, length = struct.unpack_from("<II", content, at)
        if magic in SKIPPABLE:
            end = at + 8 + length
        elif magic == FRAME_MAGIC:
            end = at + _frame_length(content[at:])
        else:
            raise ValueError(f"no frame begins with {magic:#x}")
        if end > len(content):
            raise ValueError("the archive ends inside a frame")
        yield magic, content[at:end]
        at = end


def _frame_length(frame: memoryview) -> int:
    """The length of a compressed frame, from its header and the headers of its blocks."""
    descriptor = frame[4]
    single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
    at = 5 + (0 if single else 1) + (0, 1, 2, 4)[descriptor & 3] + ((1 if single else 0), 2, 4, 8)[descriptor >> 6]
    last = 0
    while not last:
        if at + 3 > len(frame):
            raise ValueError("the archive ends inside a frame")
        block = int.from_bytes(frame[at:at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + 4 * checksum


def dictionary_of(frame: memoryview) -> bytes:
    """The dictionary in a skippable frame: as it is, or compressed as a frame of its own."""
    body = bytes(frame[8:])
    if body[:4] == struct.pack("<I", FRAME_MAGIC):
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    if body[:4] != struct.pack("<I", RAW_DICTIONARY_MAGIC):
        raise ValueError("the leading frame holds no dictionary")
    return body


def _number(field: str | None, prefix: str, suffix: str) -> int | None:
    if field and field.startswith(prefix) and field.endswith(suffix):
        digits = field[len(prefix):len(field) - len(suffix)]
        return int(digits) if digits.lstrip("-").isdigit() else None
    return None


def parse_record(data: bytes) -> dict:
    """A record's fields, payload and ``problem`` (null if headers, lengths and digests agree)."""
    record: dict = dict.fromkeys(("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "problem"))
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", VERSION):
        return record | {"problem": "no WARC header"}
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return record | {"problem": "a header line without a colon"}
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    missing = [f for f in ("warc-type", "warc-record-id", "warc-date", "content-length") if f not in fields]
    if missing:
        return record | {"problem": f"no {missing[0]}"}
    record |= {"record_type": fields["warc-type"], "url": fields.get("warc-target-uri"), "page_id": _number(fields["warc-record-id"], "<urn:page:", ">"), "refers_to": _number(fields.get("warc-refers-to"), "<urn:page:", ">")}
    if not fields["content-length"].isdigit() or int(fields["content-length"]) != len(rest) - 4 or rest[-4:] != b"\r\n\r\n":
        return record | {"problem": "the block is not as long as stated"}
    block = rest[:-4]
    if (stated := fields.get("warc-block-digest")) and stated != f"sha1:{base32_sha1(block)}":
        return record | {"problem": "the block has another digest"}
    _, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        return record | {"problem": "no HTTP header"}
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if record["record_type"] == "revisit":
        length = fields.get("x-payload-length", "")
        record |= {"payload_bytes": int(length) if length.isdigit() else None, "payload_digest": digest or None}
        if record["refers_to"] is None:
            return record | {"problem": "a revisit that refers to nothing"}
        return record if not payload else record | {"problem": "a revisit with a payload"}
    record |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": base32_sha1(payload)}
    return record if digest in ("", record["payload_digest"]) else record | {"problem": "the payload has another digest"}


def parse_archive(content: bytes) -> Iterator[dict]:
    """Records of an archive, one at a time. Damage ends it with a record that has only a ``problem``."""
    view, reader, seen = memoryview(content), zstandard.ZstdDecompressor(), False
    try:
        for magic, frame in frames_of(view):
            if magic == DICTIONARY_MAGIC and not seen:
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary_of(frame)))
            seen = True
            if magic == FRAME_MAGIC:
                yield parse_record(reader.decompressobj().decompress(bytes(frame)))
    except (ValueError, zstandard.ZstdError) as error:
        yield parse_record(b"") | {"problem": str(error)}


def read_archives(spark, path: str) -> DataFrame:
    """The records of all archives below ``path`` (see ``RECORD``); ``problem`` says what is wrong with a record.

    An archive is read by one task, as its frames follow each other without an index; their size is bounded by the
    writer. Records go on one at a time. A revisit has the digest and length of the payload, but no payload.
    """
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("problem", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for record in parse_archive(content.as_py()):
                    held.append(record)
                    size += len(record["payload"] or b"") + 200
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)
