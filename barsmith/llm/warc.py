"""WARC archives compressed with Zstandard: writer and reader.

An archive is a skippable frame (magic 0x184D2A5D) with a dictionary, then one
Zstandard frame for each record.  The dictionary may itself be compressed.

``write_archives`` makes the tasks of a DataFrame write archives of bounded size
to the shared folder and returns the manifest, a written table: a task that is
run again writes other files, and only files of the manifest are ever read.
``read_archives`` reads the files of a manifest, one frame at a time, and checks
version, required fields, declared lengths and digests.

Defined cases: a null payload is empty; a null URL becomes ``urn:row:<id>``;
control characters and blanks in a URL are percent-encoded; rows without an id
keep none; an empty table gives no archive; repeated rows are records each.  Of
records with equal payloads of at least ``min_bytes`` those with the largest id
are responses, the others revisit it; null ids count as the smallest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import materialise, prepare
from barsmith.session import ensure_checkpoint_dir, scratch_path

#: Fixed values of the formats: skippable frame with a dictionary, ordinary frame, versions, revisit profile.
DICT_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSIONS = ("WARC/1.0", "WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Record-ID", "Content-Length", "WARC-Date", "WARC-Type")
DATE = "2024-01-01T00:00:00Z"
#: Payload bytes after which a task begins another archive, and bytes that train its dictionary.
ARCHIVE_BYTES, SAMPLE_BYTES, DICT_BYTES = 64 << 20, 2 << 20, 64 << 10


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(row_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row_id}/{digest}')}"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the archive; the first sample itself where there are too few to train on."""
    import zstandard as z
    total = sum(map(len, samples))
    try:
        return z.train_dictionary(min(DICT_BYTES, max(1024, total // 16)), samples).as_bytes() if total > 20_000 else b""
    except z.ZstdError:
        return samples[0][:DICT_BYTES] if len(samples[0]) >= 8 else b""


class ArchiveWriter:
    """One archive: the dictionary frame, then a frame for each record."""

    def __init__(self, sink, dictionary: bytes):
        import zstandard as z
        self.sink = sink
        own = z.ZstdCompressionDict(dictionary) if dictionary else None
        self.frames = z.ZstdCompressor(level=3, dict_data=own, write_checksum=True)
        packed = z.ZstdCompressor(level=9).compress(dictionary) if dictionary else b""
        sink.write(struct.pack("<II", DICT_MAGIC, len(packed)) + packed)

    def record(self, head: list[tuple[str, str]], block: bytes) -> None:
        lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
        self.sink.write(self.frames.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"))


@dataclass
class Record:
    version: str
    head: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    def http(self) -> tuple[dict[str, str], bytes]:
        """Fields (lower-case names) and body of an HTTP block."""
        head, gap, body = self.block.partition(b"\r\n\r\n")
        if not gap:
            raise ValueError("the HTTP head does not end")
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}, body


def parse_record(data: bytes) -> Record:
    """A record from its decoded frame; raises ValueError on a bad head or length."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("the record's head does not end")
    version, *lines = head.decode("utf-8").split("\r\n")
    if version not in VERSIONS:
        raise ValueError(f"not a WARC version: {version[:20]!r}")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"not a field: {line[:40]!r}")
        fields[name.strip()] = value.strip()
    for name in REQUIRED:
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["Content-Length"].isdigit():
        raise ValueError("Content-Length is not a number")
    n = int(fields["Content-Length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {n}, but the frame holds {len(rest) - 4}")
    return Record(version, fields, rest[:n])


def read_frames(source) -> Iterator[bytes]:
    """Decoded frames of an archive that is read piece by piece; the dictionary comes from the leading frame."""
    import zstandard as z
    start = source.read(8)
    if len(start) < 8:
        raise ValueError("the archive is too short")
    magic, size = struct.unpack("<II", start)
    if magic != DICT_MAGIC:
        raise ValueError("no dictionary frame at the start")
    raw = source.read(size)
    if len(raw) != size:
        raise ValueError("the dictionary frame is cut off")
    if raw[:4] == struct.pack("<I", FRAME_MAGIC):
        raw = z.ZstdDecompressor().decompress(raw)
    own = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(raw)) if raw else z.ZstdDecompressor()
    held = b""
    while held or (held := source.read(1 << 20)):
        frame, out = own.decompressobj(), []
        while True:
            out.append(frame.decompress(held))
            if frame.eof:
                held = frame.unused_data
                break
            held = source.read(1 << 20)
            if not held:
                raise ValueError("the last frame is cut off")
        yield b"".join(out)


def check_payload(record: Record) -> tuple[int, str]:
    """Bytes and digest of the full payload; a response's payload is digested anew, a revisit declares both."""
    fields, body = record.http()
    declared = record.head.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    length = fields.get("content-length", "")
    if not declared or not length.isdigit():
        raise ValueError("no payload digest or length")
    if record.head["WARC-Type"] == "response":
        if len(body) != int(length) or payload_digest(body) != declared:
            raise ValueError("the payload does not have its declared length and digest")
    elif record.head["WARC-Type"] == "revisit":
        if body or "WARC-Refers-To" not in record.head:
            raise ValueError("a revisit holds a payload or refers to nothing")
    return int(length), declared


def mark_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """(id, url, payload) -> the same with ``refers_to``: the id that holds the payload, null for responses.

    Only ids and digests are grouped; each group yields one row, and ids get
    their answer back by (id, digest), which no hot payload shares.
    """
    digest = F.sha2(F.col(payload_col), 256)
    keys = pages.select(id_col, digest.alias("d"), F.octet_length(payload_col).alias("b")).where(F.col("b") >= min_bytes)
    held = keys.groupBy("d").agg(F.max(id_col).alias("top"))
    answers = (keys.select(id_col, "d").distinct().join(held, "d")
               .where(~F.col(id_col).eqNullSafe(F.col("top")))
               .select(F.col(id_col).alias("of"), F.col("d").alias("od"), F.col("top").alias("refers_to")))
    keyed = pages.withColumn("d", digest)
    return (keyed.join(answers, (F.col("d") == F.col("od")) & F.col(id_col).eqNullSafe(F.col("of")), "left")
            .drop("d", "od", "of"))


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row and return the manifest (path, records, payload_bytes)."""
    spark = pages.sparkSession
    prepare(spark)
    folder = scratch_path(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8").alias("payload"))
    marked = mark_revisits(rows, "id", "payload", min_bytes).select("id", "url", "payload", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        made: list[tuple[str, int, int]] = []
        waiting: list[tuple] = []
        state = {"sink": None, "writer": None, "n": 0, "bytes": 0, "name": ""}

        def begin() -> None:
            samples, total = [], 0
            for row in waiting:
                if row[3] is None and row[2] and total < SAMPLE_BYTES:
                    samples.append(row[2][:100_000])
                    total += len(samples[-1])
            state.update(name=f"{base}/{uuid.uuid4().hex}.warc.zst", n=0, bytes=0)
            state["sink"] = store.open_output_stream(state["name"], compression=None)
            state["writer"] = ArchiveWriter(state["sink"], train_dictionary(samples or [b""]))

        def end() -> None:
            if state["sink"] is not None:
                state["sink"].close()
                made.append((state["name"], state["n"], state["bytes"]))
                state["sink"] = None

        def flush() -> None:
            for row_id, url, payload, refers in waiting:
                if state["sink"] is not None and state["bytes"] >= archive_bytes:
                    end()
                if state["sink"] is None:
                    begin()
                digest = payload_digest(payload)
                target = (url or f"urn:row:{row_id}").encode("utf-8")
                head = [("WARC-Type", "response" if refers is None else "revisit"),
                        ("WARC-Record-ID", f"<{record_urn(row_id, digest)}>"), ("WARC-Date", DATE),
                        ("WARC-Target-URI", "".join(chr(b) if 32 < b < 127 else f"%{b:02X}" for b in target)),
                        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
                if row_id is not None:
                    head.append(("X-Row-ID", str(row_id)))
                if refers is not None:
                    head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_urn(refers, digest)}>"), ("X-Refers-To-Row-ID", str(refers))]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                state["writer"].record(head, http + (payload if refers is None else b""))
                state["n"] += 1
                state["bytes"] += len(payload)
            waiting.clear()

        held = 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = tuple(c[i].as_py() for c in batch.columns)
                waiting.append(row)
                held += len(row[2])
                if held >= SAMPLE_BYTES:
                    flush()
                    held = 0
        flush()
        end()
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in ((0, pa.string()), (1, pa.int64()), (2, pa.int64()))],
                                         names=["path", "records", "payload_bytes"])

    return materialise(marked.mapInArrow(write, "path string, records long, payload_bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder_uri: str | None = None, with_payload: bool = False) -> DataFrame:
    """A row for each record of the files in ``manifest``: id, url, payload_bytes, payload_digest, record_type, refers_to
    (and payload; null for revisits).  A record that fails a check fails the job."""
    spark = manifest.sparkSession
    prepare(spark)
    folder = folder_uri or ensure_checkpoint_dir(spark)
    ddl = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    names = [x.split()[0] for x in ddl.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(names))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                rows, held, seen = [], 0, 0
                with store.open_input_stream(path, compression=None) as source:
                    for data in read_frames(source):
                        record = parse_record(data)
                        n, digest = check_payload(record)
                        head = record.head
                        row_id, refers = head.get("X-Row-ID"), head.get("X-Refers-To-Row-ID")
                        row = (row_id and int(row_id), head.get("WARC-Target-URI"), n, digest, head["WARC-Type"], refers and int(refers))
                        if with_payload:
                            row += (record.http()[1] if head["WARC-Type"] == "response" else None,)
                        rows.append(row)
                        seen += 1
                        held += len(data)
                        if held > (8 << 20):
                            yield batch_of(rows)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{path}: {seen} records, {records} were written")
                yield batch_of(rows)

    files = manifest.count()
    return manifest.select("path", "records").repartition(max(1, files)).mapInArrow(run, ddl)
