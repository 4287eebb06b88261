"""WARC archives, written and read index first.

Method: every writing task makes one archive (each record a gzip member) and one index row per record (file, offset, length,
url, digest). A reader selects from the index alone, sorts the selected byte ranges of a file,
joins those that are close, and reads each joined range once.
"""

from __future__ import annotations

import gzip
import uuid

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.session import materialise, scratch_path

#: Smaller payloads are always written in full.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
#: Ranges this close are read as one, up to this size (or one record).
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20
#: Records of so many bytes of a file are read by the same task.
PIECE_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _line(value: str) -> str:
    """A header value cannot hold line ends or other control characters."""
    return "".join(c if ord(c) >= 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = HTTP % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {_line(url)}")
    if revisit:
        lines += [f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


INDEX = (
    "page_id bigint, url string, file string, offset bigint, length bigint, digest string, "
    "payload_bytes bigint, record_type string, refers_to bigint"
)
_INDEX = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _write(folder: str):
    def batches(parts):
        out, at, name = None, 0, ""
        try:
            for batch in parts:
                rows = []
                for r in batch.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        # A new name for every attempt: a repeated task leaves no half-read file.
                        name, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        fs, path = pyarrow.fs.FileSystem.from_uri(name)
                        out = fs.open_output_stream(path, compression=None)  # members are compressed here
                    payload = (r["payload"] or "").encode()
                    revisit = r["refers_to"] is not None
                    data = record(r["page_id"], r["url"], payload, r["digest"], r["refers_to"], revisit)
                    data = gzip.compress(data, mtime=0)
                    out.write(data)
                    rows.append(
                        {
                            "page_id": r["page_id"],
                            "url": r["url"],
                            "file": name,
                            "offset": at,
                            "length": len(data),
                            "digest": r["digest"],
                            "payload_bytes": len(payload),
                            "record_type": "revisit" if revisit else "response",
                            "refers_to": r["refers_to"],
                        }
                    )
                    at += len(data)
                yield pa.RecordBatch.from_pylist(rows, _INDEX)
        finally:
            if out is not None:
                out.close()

    return batches


def _uri(folder: str) -> str:
    return folder if "://" in folder else f"file://{folder.replace('file:', '', 1)}"


def write_archives(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write one record per page and return the index, itself stored in the shared folder.

    Of pages with equal payloads of REVISIT_BYTES or more, those with the largest page_id are
    responses and the others refer to it; smaller payloads are always responses. A null html is an
    empty payload, a null url writes no target. A null page_id is below all others: its record is
    a response only if no other page has the payload, or all have null. Rows repeating the
    largest page_id are all responses. Other columns are not archived; no rows, no archives.
    """
    folder = _uri(folder or scratch_path(pages.sparkSession, "warc"))
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"digest": F.sha1(F.encode("payload", "UTF-8")), "check": F.xxhash64("payload")})
    large = F.octet_length("payload") >= REVISIT_BYTES
    # Groups of two or more only; counts are combined before the shuffle.
    last = rows.where(large).groupBy("digest", "check").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    last = last.where("n > 1").select("digest", "check", "last")
    marked = rows.join(last, ["digest", "check"], "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"),
    )
    return materialise(marked.mapInArrow(_write(folder), INDEX), "warc-index")


def joined_ranges(rows: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """(offset, bytes, numbers of the records in it) for records (offset, length) sorted by offset."""
    out: list[list] = []
    for i, (offset, length) in enumerate(rows):
        end = offset + length
        if out and offset - (out[-1][0] + out[-1][1]) <= GAP_BYTES and end - out[-1][0] <= RANGE_BYTES:
            out[-1][1] = max(out[-1][1], end - out[-1][0])
            out[-1][2].append(i)
        else:
            out.append([offset, length, [i]])
    return [tuple(x) for x in out]


RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, declared_digest string, payload binary"
_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("declared_digest", pa.string()), ("payload", pa.binary())]
)


def _read(parts):
    for batch in parts:  # sorted by file and offset
        rows = batch.to_pylist()
        at = 0
        while at < len(rows):
            name = rows[at]["file"]
            stop = next((i for i in range(at, len(rows)) if rows[i]["file"] != name), len(rows))
            fs, path = pyarrow.fs.FileSystem.from_uri(name)
            with fs.open_input_file(path) as source:
                for offset, size, held in joined_ranges([(r["offset"], r["length"]) for r in rows[at:stop]]):
                    source.seek(offset)
                    data = source.read(size)
                    out = []
                    for i in held:
                        r = rows[at + i]
                        member = data[r["offset"] - offset : r["offset"] - offset + r["length"]]
                        headers, payload = parse(gzip.decompress(member))
                        named = headers["WARC-Page-ID"]
                        out.append(
                            {
                                "page_id": int(named) if named else None,
                                "url": headers.get("WARC-Target-URI"),
                                "record_type": headers["WARC-Type"],
                                "refers_to": int(headers["WARC-Refers-To-Page-ID"]) if "WARC-Refers-To-Page-ID" in headers else None,
                                "declared_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                                "payload": payload if headers["WARC-Type"] == "response" else None,
                            }
                        )
                    yield pa.RecordBatch.from_pylist(out, _RECORDS)
            at = stop


def read_records(index: DataFrame) -> DataFrame:
    """The records an index (or any selection of its rows) names, read by joined byte ranges:
    page_id, url, record_type, refers_to, declared_digest, payload (null for a revisit)."""
    # A task reads about PIECE_BYTES; its number cannot follow the index, whose rows are small.
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 1) // PIECE_BYTES)
    piece = F.floor(F.col("offset") / F.lit(PIECE_BYTES))
    placed = index.select("file", "offset", "length", piece.alias("piece")).repartition(tasks, "file", "piece")
    return placed.sortWithinPartitions("file", "offset").drop("piece").mapInArrow(_read, RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """Records with the size and SHA-1 of the full payload, taken from the bytes read; a revisit
    takes those of the response it refers to."""
    sized = records.withColumns({"bytes": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")}).drop("payload")
    sized = materialise(sized, "warc-records")  # the archives are read once
    known = sized.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("bytes").alias("full_bytes"), F.col("sha1").alias("full_sha1"), F.col("sha1").alias("declared_digest")
    )
    known = known.dropDuplicates(["refers_to", "declared_digest"])
    joined = sized.join(known, ["refers_to", "declared_digest"], "left")
    return joined.select(
        "page_id",
        "url",
        F.coalesce("bytes", "full_bytes").alias("payload_bytes"),
        F.coalesce("sha1", "full_sha1").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
