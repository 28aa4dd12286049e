"""Web archives of individually compressed records with a Zstandard dictionary in front.

Each task writes archives of its own rows: it trains a dictionary on the first records, puts
it into a leading skippable frame, and compresses every record as a frame of its own, so that
a record can be read with the dictionary and its own bytes. Equal payloads are
stored once: the record with the largest key is the response, others are revisits of it.

Archives get unique names and count only if the task's manifest row is kept, so a task that is
lost or run twice leaves unlisted files and no wrong result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.frames import column, text_or_empty
from forecourt.staging import new_path, stage

# Fixed values of the formats: the skippable frame that holds a dictionary, a frame's
# first bytes, the revisit profile, and the end of a record.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

URN = "urn:record:"
SAMPLE_BYTES = 1 << 20  # of records a dictionary is trained on
PIECE_BYTES = 4 << 10
DICTIONARY_BYTES = 32 << 10
READERS = 10_000  # tasks that read archives, at most
ARCHIVE_BYTES = 1 << 30  # compressed; then the task starts a new archive

RECORD = "key string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store and the path in it; a path without scheme is a local one."""
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(text: str) -> str:
    """A header value without characters that would end its line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(key: str | None, url: str | None, payload: bytes, refers: str | None, date: str) -> bytes:
    """One response, or a revisit if it refers to another key, without its payload then."""
    kind = "response" if refers is None else "revisit"
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    if refers is None:
        block += payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{URN}{_line(key)}>" if key is not None else f"<{uuid.uuid4().urn}>",
        "WARC-Date": date,
        "WARC-Target-URI": _line(url) if url is not None else None,
        "WARC-Payload-Digest": f"sha1:{sha1(payload)}",
        "WARC-Refers-To": f"<{URN}{_line(refers)}>" if refers is not None else None,
        "WARC-Profile": REVISIT if refers is not None else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = [f"{k}: {v}" for k, v in head.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + END


class Archive:
    """An archive being written. The first records wait until the dictionary is trained."""

    def __init__(self, folder: str, level: int = 3):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, path = open_store(self.uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.file = store.open_output_stream(path, compression=None)
        self.level, self.waiting, self.held = level, [], 0
        self.compressor = None
        self.records = self.raw = self.size = 0

    def add(self, data: bytes) -> None:
        self.records += 1
        self.raw += len(data)
        if self.compressor:
            self._write(self.compressor.compress(data))
            return
        self.waiting.append(data)
        self.held += len(data)
        if self.held >= SAMPLE_BYTES:
            self._start()

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def _start(self) -> None:
        dictionary = _dictionary(self.waiting)
        if dictionary:
            content = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
            self._write(struct.pack("<II", SKIPPABLE, len(content)) + content)
        self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=dictionary)
        for data in self.waiting:
            self._write(self.compressor.compress(data))
        self.waiting = []

    def close(self) -> None:
        if not self.compressor:
            self._start()
        self.file.close()


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from pieces of the records; without records there is none.

    Training needs several samples, so long records give several pieces. Where there are too few
    bytes to train on, the pieces themselves are the dictionary.
    """
    pieces, room = [], SAMPLE_BYTES
    share = max(PIECE_BYTES, SAMPLE_BYTES // max(1, len(records)))
    for data in records:
        for at in range(0, min(len(data), share, room), PIECE_BYTES):
            pieces.append(data[at : at + PIECE_BYTES])
            room -= len(pieces[-1])
        if room <= 0:
            break
    if not pieces:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, k=512, d=8)
    except zstandard.ZstdError:
        content = b"".join(pieces)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archives(
    df: DataFrame,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
    folder: str | None = None,
) -> DataFrame:
    """Write every row as a record; returns the manifest (archive, records, raw, size), staged.

    A null payload is empty, a very long one is held whole by its task. Equal payloads of at least `min_bytes` form a group: its rows with the
    largest key are responses, the others revisits. Rows with a null key are responses and in
    no group. Rows that repeat the largest key are all responses, under one record identifier. Other
    columns play no part, whatever their names. A null address is left out. An empty frame gives an empty manifest.
    """
    spark = df.sparkSession
    folder = folder or new_path(spark, "archives")
    rows = df.select(
        column(df, key).alias("key"),
        column(df, url).cast("string").alias("url"),
        text_or_empty(df, payload).cast("binary").alias("payload"),
    ).withColumn(
        "same",
        F.when(
            (F.octet_length("payload") >= min_bytes) & F.col("key").isNotNull(),
            F.sha2("payload", 256),
        ),
    )
    groups = stage(
        rows.filter("same is not null")
        .groupBy("same")
        .agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("keep"))
        .filter("n > 1")
        .drop("n"),
        "payload-groups",
    )
    # Payloads are shuffled once, unsorted; hot ones are split by the adaptive skew join.
    marked = rows.join(groups.hint("shuffle_hash"), "same", "left").select(
        F.col("key").cast("string").alias("key"),
        "url",
        "payload",
        F.when(F.col("key") < F.col("keep"), F.col("keep").cast("string")).alias("refers"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            columns = (batch[c] for c in ("key", "url", "payload", "refers"))
            for row in zip(*columns, strict=True):
                if archive is None:
                    archive = Archive(folder)
                k, u, p, r = (x.as_py() for x in row)
                archive.add(record(k, u, p, r, date))
                if archive.size >= ARCHIVE_BYTES:
                    archive.close()
                    done.append(archive)
                    archive = None
        if archive:
            archive.close()
            done.append(archive)
        if done:
            yield pa.RecordBatch.from_pylist(
                [
                    {"archive": a.uri, "records": a.records, "raw": a.raw, "size": a.size}
                    for a in done
                ]
            )

    manifest = marked.mapInArrow(run, "archive string, records long, raw long, size long")
    return stage(manifest, "manifest")


def records(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an open archive."""
    start, dictionary = file.read(8), None
    if len(start) == 8 and struct.unpack("<I", start[:4])[0] == SKIPPABLE:
        content = file.read(struct.unpack("<I", start[4:])[0])
        if content.startswith(FRAME):
            content = zstandard.ZstdDecompressor().decompress(content)
        dictionary, start = zstandard.ZstdCompressionDict(content), b""
    rest = io.BufferedReader(_Chained(start, file))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
        rest, read_across_frames=True
    )
    lines = io.BufferedReader(reader, 1 << 18)
    while first := lines.readline():
        if first.strip() != b"WARC/1.1":
            raise ValueError(f"no record begins with {first[:40]!r}")
        fields = {}
        while line := lines.readline().strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        block = lines.read(int(fields["content-length"]))
        if lines.read(4) != END:
            raise ValueError("a record does not end where its length says")
        yield fields, block


class _Chained(io.RawIOBase):
    """Some bytes that were read already, and then the file they came from."""

    def __init__(self, start: bytes, file):
        self.start, self.file = start, file

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.start[: len(into)] or self.file.read(len(into))
        self.start = self.start[len(into) :]
        into[: len(data)] = data
        return len(data)


def _parsed(fields: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(END)
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload), sha1(payload)) != (size, digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} does not match its digest")

    def named(field: str) -> str | None:
        value = fields.get(field, "").strip("<>")
        return value.removeprefix(URN) if value.startswith(URN) else None

    return {
        "key": named("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": named("warc-refers-to"),
    }


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the manifest's archives; `payloads` adds what responses hold.

    Each archive is read in order by one task. Digests of responses are computed anew and must agree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(f, pa.int64() if f == "payload_bytes" else pa.string()) for f in names]
            + [("payload", pa.binary())] * payloads
        )
        for batch in batches:
            for uri in batch["archive"].to_pylist():
                store, path = open_store(uri)
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as file:
                    for fields, block in records(file):
                        row = _parsed(fields, block)
                        if payloads:
                            revisit = row["record_type"] == "revisit"
                            row["payload"] = None if revisit else block.partition(END)[2]
                        rows.append(row)
                        size += len(block)
                        if len(rows) == 10_000 or payloads and size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    names = [f.split()[0] for f in RECORD.split(", ")]
    archives = manifest.select("archive")
    # A task per archive: with a number of its own this shuffle is not merged, small as it is.
    archives = archives.repartition(max(1, min(manifest.count(), READERS)), "archive")
    return archives.mapInArrow(run, RECORD + ", payload binary" * payloads)
