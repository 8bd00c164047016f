"""Legacy web archives: ARC records read by version, turned into equivalent WARC records.

ARC version 1 heads each record with ``URL IP date type length``, version 2 with
``URL IP date type status checksum location offset filename length``; which one holds is declared by
the first record, ``filedesc://``.  The converter parses that line from its right end (URLs may hold
spaces), takes exactly the declared length, and synthesises what WARC wants: a record id derived from
the record's content and place, an ISO timestamp, the record type, block and payload digests.

Archives are compressed record by record, as ``.arc.gz`` and ``.warc.gz`` files are.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

#: WARC's revisit profile, and the date used where a record's own can't be read.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
UNKNOWN_DATE = "19700101000000"
#: Level of compression, and bytes that a decompressor is fed at a time.
LEVEL, STEP = 2, 1 << 14
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:lexloom:arc-record")


class ArcError(ValueError):
    """A record does not follow its declared version or length."""


@dataclass
class ArcRecord:
    version: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    status: int | None = None
    checksum: str | None = None
    location: str | None = None
    filename: str | None = None


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes
    extra: dict[str, str] = field(default_factory=dict)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def squeezed(data: bytes) -> bytes:
    """A gzip member without a time stamp: equal records give equal bytes."""
    return gzip.compress(data, LEVEL, mtime=0)


def members(data: bytes) -> Iterator[bytes]:
    """The content of each gzip member in turn; data that is not compressed is passed as one piece.

    The decompressor is fed in steps, since it hands back a copy of what it did not use.
    """
    if data[:2] != b"\x1f\x8b":
        if data:
            yield data
        return
    view, at = memoryview(data), 0
    while at < len(data):
        if data[at] in b"\0\n\r":
            at += 1
            continue
        d = zlib.decompressobj(31)
        out = []
        while not d.eof:
            if at >= len(data):
                raise ArcError("gzip member is cut off")
            try:
                out.append(d.decompress(view[at : at + STEP]))
            except zlib.error as e:
                raise ArcError(f"gzip member: {e}") from e
            at = min(at + STEP, len(data)) - len(d.unused_data)
        yield b"".join(out)


# --- ARC ------------------------------------------------------------------------------------------


def _safe(value: str | None) -> str:
    """A header field without the characters that end it."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "") or "-"


def arc_filedesc(name: str, version: int, date: str = UNKNOWN_DATE) -> bytes:
    fields = "URL IP-address Archive-date Content-type Archive-length" if version == 1 else "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
    body = f"{version} 0 lexloom\n{fields}\n".encode()
    middle = "" if version == 1 else f" 200 - - 0 {_safe(name)}"
    return f"filedesc://{_safe(name)} 0.0.0.0 {date} text/plain{middle} {len(body)}\n".encode() + body + b"\n"


def arc_record(record: ArcRecord, offset: int = 0) -> bytes:
    head = [_safe(record.url), _safe(record.ip), record.date, _safe(record.mime)]
    if record.version == 2:
        head += [str(record.status or 200), _safe(record.checksum), _safe(record.location), str(offset), _safe(record.filename)]
    return " ".join([*head, str(len(record.block))]).encode() + b"\n" + record.block + b"\n"


def read_arc(data: bytes, version: int | None = None) -> Iterator[ArcRecord]:
    """Records of one piece of an ARC file (all of it, or a gzip member).

    ``version`` is needed only for a piece that does not start with the ``filedesc`` record.
    """
    at = 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ArcError("header line is cut off")
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        found = re.match(r"(\d+) ", data[end + 1 : end + 40].decode("latin-1")) if line.startswith("filedesc://") else None
        if found:
            version = int(found[1])
        if version not in (1, 2):
            raise ArcError(f"ARC version {version} is not known")
        parts = line.rsplit(" ", 4 if version == 1 else 9)
        if len(parts) != (5 if version == 1 else 10) or not parts[-1].isdigit():
            raise ArcError(f"header line does not have the fields of version {version}")
        length = int(parts[-1])
        block = data[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ArcError("record is shorter than its declared length")
        url, ip, date, mime = parts[:4]
        record = ArcRecord(version, url, ip, date, mime, block)
        if version == 2:
            record.status = int(parts[4]) if parts[4].isdigit() else None
            record.checksum, record.location, record.filename = (None if v == "-" else v for v in (parts[5], parts[6], parts[8]))
        yield record
        at = end + 1 + length


# --- conversion -----------------------------------------------------------------------------------


def iso_date(date: str) -> str:
    """ARC's 14 digits (12 in early files) as a WARC timestamp; anything else becomes the epoch."""
    digits = date.ljust(14, "0") if re.fullmatch(r"\d{12}|\d{14}", date) else UNKNOWN_DATE
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:]}Z"


def http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """Head and payload of an HTTP response, or None."""
    if not block.startswith(b"HTTP/"):
        return None
    head, gap, payload = block.partition(b"\r\n\r\n")
    return (head + gap, payload) if gap else (block, b"")


def http_header(head: bytes, name: str) -> str | None:
    found = re.search(rf"(?im)^{re.escape(name)}:[ \t]*(.*?)\r?$", head.decode("latin-1"))
    return found[1] if found else None


def record_id(archive: str, sequence: int, record: ArcRecord, digest: str) -> str:
    """The same for the same record at the same place, so a repeated conversion gives the same ids; ``digest`` is the block's."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, ' '.join((archive, str(sequence), record.url, record.date, digest)))}>"


def convert(archive: str, sequence: int, record: ArcRecord) -> WarcRecord:
    """The WARC record that says what ``record`` says; only an archive's first record describes the file."""
    digest = sha1_base32(record.block)
    headers = {"WARC-Record-ID": record_id(archive, sequence, record, digest), "WARC-Date": iso_date(record.date), "WARC-Block-Digest": f"sha1:{digest}"}
    http = http_parts(record.block)
    if not sequence and record.url.startswith("filedesc://"):
        headers |= {"WARC-Type": "warcinfo", "WARC-Filename": record.url.removeprefix("filedesc://"), "Content-Type": "application/warc-fields"}
    else:
        headers["WARC-Target-URI"] = record.url
        if record.ip not in ("-", "0.0.0.0"):
            headers["WARC-IP-Address"] = record.ip
        if http:
            headers |= {"WARC-Type": "response", "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha1:{sha1_base32(http[1])}"}
        else:
            headers |= {"WARC-Type": "resource", "Content-Type": record.mime, "WARC-Payload-Digest": f"sha1:{sha1_base32(record.block)}"}
    return WarcRecord(headers, record.block)


def revisit(record: WarcRecord, refers_to: dict[str, str]) -> WarcRecord:
    """``record`` without its payload, pointing at the response that holds it."""
    head, _ = http_parts(record.block) or (b"", b"")
    headers = record.headers | {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Block-Digest": f"sha1:{sha1_base32(head)}"} | refers_to
    return WarcRecord(headers, head)


# --- WARC -----------------------------------------------------------------------------------------


def warc_bytes(record: WarcRecord) -> bytes:
    lines = [f"{k}: {v}" for k, v in (record.headers | record.extra).items()]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(record.block)}\r\n\r\n").encode() + record.block + b"\r\n\r\n"


def read_warc(data: bytes) -> Iterator[WarcRecord]:
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ArcError("not a WARC record")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        if not headers.get("Content-Length", "").isdigit():
            raise ArcError("WARC record without a length")
        length = int(headers.pop("Content-Length"))
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            raise ArcError("WARC record is shorter than its declared length")
        yield WarcRecord(headers, block)
        at = end + 4 + length
