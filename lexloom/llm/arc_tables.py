"""Archives as tables: pages into ARC, ARC into WARC with revisits, WARC back into rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm import arc
from lexloom.llm.runtime import bounded_batches, discard, session_of, staged

#: One row per archive file; ``content`` is its gzip members one after the other.
ARCHIVE_SCHEMA = "archive string, content binary"
DIGEST_SCHEMA = "archive string, sequence long, url string, record_key long, record_id string, date string, type string, payload_bytes long, payload_sha1 string, error string"
WARC_SCHEMA = "archive string, sequence long, record_id string, type string, url string, date string, record_key long, payload_bytes long, payload_digest string, refers_to string, refers_to_key long, block binary, error string"
#: What a revisit says of the record that holds its payload, by its place in the archive.
TARGET = ("sequence", "first_key", "first_id", "first_url", "first_date")
#: Header that carries the row's own key through the archives.
KEY_HEADER = "X-Record-Key"


def _fields(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def _file(name: str, members: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(members)], pa.binary())], names=["archive", "content"])


def pages_to_arc(pages: DataFrame, key_col: str, url_col: str, body_col: str, version: int | None = None) -> DataFrame:
    """ARC files (ARCHIVE_SCHEMA) of ``pages``, one for each Arrow batch of a few MB.

    ``version`` 1 or 2; None lets archives alternate.  A null body is an empty payload, a null url is
    written as ``-``; a null key leaves its header out.  An archive is named by its task's partition and
    the batch's number there, so archives of one job never share a name, whatever rows repeat.
    """
    bounded_batches(session_of(pages))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        for number, batch in enumerate(b for b in batches if b.num_rows):
            name = f"pages-{part:06d}-{number:06d}.arc.gz"
            kind = version or 1 + (part + number) % 2
            out = [arc.squeezed(arc.arc_filedesc(name, kind))]
            at = len(out[0])
            for key, url, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                payload = (body or "").encode()
                own = f"{KEY_HEADER}: {key}\r\n" if key is not None else ""
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                out.append(arc.squeezed(arc.arc_record(arc.ArcRecord(kind, url or "-", "0.0.0.0", arc.UNKNOWN_DATE, "text/html", block, 200, None, None, name), at)))
                at += len(out[-1])
            yield _file(name, out)

    return pages.select(F.col(key_col).cast("long"), F.col(url_col).cast("string"), F.col(body_col).cast("string")).mapInArrow(write, ARCHIVE_SCHEMA)


def _records(content: bytes | None) -> Iterator[tuple[int, arc.ArcRecord]]:
    """(sequence, record) of an ARC file; the first record declares the version of all."""
    version, sequence = None, 0
    for piece in arc.members(content or b""):
        for record in arc.read_arc(piece, version):
            version = record.version
            yield sequence, record
            sequence += 1


def arc_digests(archives: DataFrame) -> DataFrame:
    """DIGEST_SCHEMA: what each ARC record will be as a WARC record, and its payload's size and digest, without content.

    Where an archive can't be read on, a row with ``error`` ends it; other archives are not affected.
    """
    bounded_batches(session_of(archives))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            rows: list[tuple] = []
            for archive, content in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                sequence = -1
                try:
                    for sequence, record in _records(content):
                        headers = arc.convert(archive, sequence, record).headers
                        http = arc.http_parts(record.block)
                        key = arc.http_header(http[0], KEY_HEADER) if http else None
                        digest = headers.get("WARC-Payload-Digest", headers["WARC-Block-Digest"]).removeprefix("sha1:")
                        rows.append((archive, sequence, record.url, int(key) if key and key.lstrip("-").isdigit() else None, headers["WARC-Record-ID"], headers["WARC-Date"], headers["WARC-Type"], len(http[1] if http else record.block), digest, None))
                except arc.ArcError as e:
                    rows.append((archive, sequence + 1, *[None] * 7, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_fields(DIGEST_SCHEMA))

    return archives.select("archive", "content").mapInArrow(read, DIGEST_SCHEMA)


def find_revisits(digests: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(archive, TARGET columns) of the records that revisit another one.

    Of HTTP responses with equal payloads of at least ``min_bytes`` bytes the one with the largest
    ``record_key`` (ties: the largest record id, which no two records share) is the original.  Names and
    digests alone are shuffled, combined before it by the aggregate; the join back is on the digest,
    which adaptive execution splits where one payload is very common.
    """
    small: Column = (F.col("type") == "response") & (F.col("payload_bytes") >= min_bytes)
    own = digests.where(small)
    first = (
        own.groupBy("payload_sha1").agg(F.max(F.struct("record_key", "record_id", "url", "date")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("payload_sha1", F.col("first.record_key").alias("first_key"), F.col("first.record_id").alias("first_id"), F.col("first.url").alias("first_url"), F.col("first.date").alias("first_date"))
    )
    return own.join(first, "payload_sha1").where("record_id <> first_id").select("archive", *TARGET)


def arc_to_warc(archives: DataFrame, revisits: DataFrame) -> DataFrame:
    """WARC archives (ARCHIVE_SCHEMA), one for each ARC archive, every record converted.

    Records in ``revisits`` (archive, TARGET columns) lose their payload and point at the original.  The
    revisits of an archive travel to it as one list, which is no longer than the archive; only archives
    are matched, compressed as they are.  An archive that can't be read fails the job.
    """
    bounded_batches(session_of(archives))
    lists = revisits.groupBy("archive").agg(F.collect_list(F.struct(*TARGET)).alias("targets"))
    joined = archives.select("archive", "content").join(lists, "archive", "left")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content, targets in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                known = {t["sequence"]: t for t in targets or ()}
                out = []
                for sequence, record in _records(content):
                    w = arc.convert(archive, sequence, record)
                    if t := known.get(sequence):
                        w = arc.revisit(w, {"WARC-Refers-To": t["first_id"], "WARC-Refers-To-Target-URI": t["first_url"], "WARC-Refers-To-Date": t["first_date"]})
                        if t["first_key"] is not None:
                            w.extra["X-Refers-To-Key"] = str(t["first_key"])
                    out.append(arc.squeezed(arc.warc_bytes(w)))
                yield _file(archive.removesuffix(".arc.gz") + ".warc.gz", out)

    return joined.select("archive", "content", "targets").mapInArrow(convert, ARCHIVE_SCHEMA)


def read_warc(archives: DataFrame, with_block: bool = True) -> DataFrame:
    """A row per WARC record (WARC_SCHEMA); ``with_block`` False leaves the blocks null.

    ``payload_bytes`` and the digest are those of the full payload: measured for records that hold
    it, from the headers of revisits.  Where an archive can't be read on, a row with ``error`` ends it.
    """
    bounded_batches(session_of(archives))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]
        for batch in batches:
            rows: list[tuple] = []
            for archive, content in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                sequence = 0
                try:
                    for piece in arc.members(content or b""):
                        for r in arc.read_warc(piece):
                            h = r.headers
                            http = arc.http_parts(r.block)
                            own = arc.http_header(http[0], KEY_HEADER) if http else None
                            key = int(own) if own and own.lstrip("-").isdigit() else None
                            if h["WARC-Type"] == "revisit":
                                size = arc.http_header(http[0], "Content-Length") if http else None
                                digest, n = h.get("WARC-Payload-Digest", "").removeprefix("sha1:"), int(size) if size else None
                            else:
                                payload = http[1] if http else r.block
                                digest, n = arc.sha1_base32(payload), len(payload)
                            to = h.get("X-Refers-To-Key")
                            rows.append((archive, sequence, h["WARC-Record-ID"], h["WARC-Type"], h.get("WARC-Target-URI"), h["WARC-Date"], key, n, digest, h.get("WARC-Refers-To"), int(to) if to else None, r.block if with_block else None, None))
                            sequence += 1
                except (arc.ArcError, KeyError) as e:
                    rows.append((archive, sequence, *[None] * 10, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_fields(WARC_SCHEMA))

    return archives.select("archive", "content").mapInArrow(read, WARC_SCHEMA)


def readable(kept: Column) -> Column:
    """``kept`` for rows without ``error``; others fail the query."""
    return F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("archive "), "archive", F.lit(": "), "error"))).otherwise(kept)


def pages_through_archives(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``pages`` written as ARC, converted to WARC with revisits, and read back (WARC_SCHEMA without blocks).

    ARC and WARC archives are written to the shared folder; a lost executor costs a re-read, never a
    second set of identifiers.  A repeated key gives a record for each of its rows; empty tables give
    empty archives; other columns are left aside.  An archive that can't be read on fails the query.
    """
    legacy = staged(pages_to_arc(pages, key_col, url_col, body_col), "arc")
    revisits = staged(find_revisits(arc_digests(legacy).where(readable(F.lit(True))), min_bytes), "revisits")
    archives = staged(arc_to_warc(legacy, revisits), "warc")
    discard(legacy, revisits)
    return read_warc(archives, with_block=False).where(readable(F.col("type").isin("response", "revisit")))
