"""TIFF as a media column: image directories walked, segments decoded, predictors undone, one row per page.

Reads classic and big TIFF of either byte order, strips and tiles, chunky and planar samples of 8,
16, 32 or 64 bits, uncompressed, PackBits, LZW and deflate, predictors 1 (none), 2 (horizontal
difference) and 3 (floating point).  ``write_tiff`` produces the same range of classic files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexloom.llm.runtime import bounded_batches, session_of

# Fixed values of the format: compression codes, tags, bytes per field type.
RAW, LZW, DEFLATE, PACKBITS, DEFLATE_OLD = 1, 5, 8, 32773, 32946
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_SIZE, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_SIZE, FORMAT = 317, 322, 323, 324, 325, 339
FIELD = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 13: "I", 16: "Q", 17: "q", 18: "Q"}
CLEAR, END = 256, 257


class TiffError(ValueError):
    """The file or page does not follow the format, or uses a feature outside the range above."""


@dataclass
class Page:
    page: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    predictor: int
    tiled: bool
    pixels: bytes


# --- codecs ---------------------------------------------------------------------------------------


def packbits_encode(data: bytes) -> bytes:
    """Runs of three or more become a repeat packet, the rest literal packets of up to 128 bytes."""
    out = bytearray()
    a = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(a)) + 1
    starts = np.r_[0, edges].astype(np.int64)
    lengths = np.diff(np.r_[starts, len(a)])
    literal = 0

    def flush(upto: int) -> None:
        for at in range(literal, upto, 128):
            part = data[at : min(at + 128, upto)]
            out.append(len(part) - 1)
            out.extend(part)

    long_runs = np.flatnonzero(lengths >= 3)
    for start, length in zip(starts[long_runs].tolist(), lengths[long_runs].tolist(), strict=True):
        flush(start)
        left = length
        while left >= 2:
            n = min(left, 128)
            out += bytes((257 - n, data[start]))
            left -= n
        literal = start + length - left
    flush(len(data))
    return bytes(out)


def packbits_decode(data: bytes, most: int) -> bytes:
    """At least the first ``most`` bytes, if there are so many."""
    out, at, end, made = [], 0, len(data), 0
    while at < end and made < most:
        n = data[at]
        at += 1
        if n < 128:
            out.append(data[at : at + n + 1])
            at += n + 1
            made += n + 1
        elif n > 128:
            if at >= end:
                raise TiffError("PackBits packet is cut off")
            out.append(data[at : at + 1] * (257 - n))
            at += 1
            made += 257 - n
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    """Most significant bit first, codes widen one code early, table cleared before it is full."""
    codes, widths = [CLEAR], [9]
    table: dict[tuple[int, int], int] = {}
    following, width, prefix = 258, 9, -1
    for byte in data:
        if prefix < 0:
            prefix = byte
            continue
        key = (prefix, byte)
        found = table.get(key)
        if found is not None:
            prefix = found
            continue
        codes.append(prefix)
        widths.append(width)
        table[key] = following
        following += 1
        if following > 4093:
            codes.append(CLEAR)
            widths.append(width)
            table = {}
            following, width = 258, 9
        elif following >= (1 << width) - 1:
            width += 1
        prefix = byte
    if prefix >= 0:
        codes.append(prefix)
        widths.append(width)
        following += 1
        if following >= (1 << width) - 1 and width < 12:
            width += 1
    codes.append(END)
    widths.append(width)
    c, w = np.array(codes, np.int64), np.array(widths, np.int64)
    bit = np.repeat(w - 1, w) - (np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w))
    return np.packbits((np.repeat(c, w) >> bit & 1).astype(np.uint8)).tobytes()


_SINGLE = [bytes((i,)) for i in range(256)] + [b"", b""]


def lzw_decode(data: bytes, most: int) -> bytes:
    """At least the first ``most`` bytes, if there are so many."""
    out: list[bytes] = []
    made = 0
    table = _SINGLE.copy()
    width, hold, bits, limit = 9, 0, 0, 511
    before = b""
    for byte in data:
        hold = hold << 8 | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = hold >> bits
        hold &= (1 << bits) - 1
        if code == CLEAR:
            table = _SINGLE.copy()
            width, limit, before = 9, 511, b""
            continue
        if code == END or made >= most:
            return b"".join(out)
        if not before:
            if code > 255:
                raise TiffError("LZW stream starts with a code that is not yet defined")
            before = table[code]
            out.append(before)
            made += 1
            continue
        size = len(table)
        if code < size:
            now = table[code]
            table.append(before + now[:1])
        elif code == size:
            now = before + before[:1]
            table.append(now)
        else:
            raise TiffError("LZW code beyond the table")
        out.append(now)
        made += len(now)
        before = now
        if size + 2 >= limit and width < 12:
            width += 1
            limit = (1 << width) - 1
    return b"".join(out)


#: Most bytes that a byte of each codec can stand for: the longest run of a packet, of a deflate block, of a table's string.
MOST_FROM_BYTE = {RAW: 1, PACKBITS: 64, DEFLATE: 1032, DEFLATE_OLD: 1032, LZW: 2731}


def decode_segment(data: bytes, compression: int, need: int) -> bytes:
    """The first ``need`` bytes of a segment; whatever its codec would make beyond them is not made."""
    if need > MOST_FROM_BYTE[compression] * len(data):
        raise TiffError("a segment is too short")
    if compression == RAW:
        return data
    if compression == PACKBITS:
        return packbits_decode(data, need)
    if compression == LZW:
        return lzw_decode(data, need)
    try:
        return zlib.decompressobj().decompress(data, need)
    except zlib.error as e:
        raise TiffError(f"deflate: {e}") from e


def encode_segment(data: bytes, compression: int) -> bytes:
    return {RAW: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: zlib.compress}[compression](data)


# --- predictors -----------------------------------------------------------------------------------


def undo_predictor(rows: np.ndarray, predictor: int, order: str) -> np.ndarray:
    """``rows``: (rows, pixels, samples) in the file's sample type; the result has the same shape."""
    if predictor == 1:
        return rows
    if predictor == 2:
        if rows.dtype.kind == "f":
            rows = rows.view(f"{order}u{rows.dtype.itemsize}")
        native = rows.astype(rows.dtype.newbyteorder("="))
        return np.cumsum(native, axis=1, dtype=native.dtype).astype(rows.dtype)
    if predictor == 3:
        h, w, s = rows.shape
        size = rows.dtype.itemsize
        flat = np.frombuffer(rows.tobytes(), np.uint8).reshape(h, w * s * size)
        summed = np.cumsum(flat.reshape(h, -1, s), axis=1, dtype=np.uint8).reshape(h, size, w * s)
        return summed.transpose(0, 2, 1).copy().view(f">f{size}" if size > 1 else "u1").reshape(h, w, s).astype(rows.dtype if rows.dtype.kind == "f" else f"{order}f{size}")
    raise TiffError(f"predictor {predictor} is not supported")


def apply_predictor(rows: np.ndarray, predictor: int) -> np.ndarray:
    if predictor == 2:
        rows = rows.copy()
        rows[:, 1:] -= rows[:, :-1].copy()
    return rows


# --- reading --------------------------------------------------------------------------------------


class _File:
    def __init__(self, data: bytes):
        self.data = data
        self.order = {b"II": "<", b"MM": ">"}.get(data[:2])
        if not self.order or len(data) < 8:
            raise TiffError("not a TIFF file")
        kind = struct.unpack_from(self.order + "H", data, 2)[0]
        if kind not in (42, 43):
            raise TiffError("not a TIFF file")
        self.big = kind == 43
        self.first = self.unpack("Q", 8) if self.big else self.unpack("I", 4)

    def unpack(self, kind: str, at: int) -> int:
        try:
            return struct.unpack_from(self.order + kind, self.data, at)[0]
        except struct.error as e:
            raise TiffError("the file is cut off") from e

    def directories(self) -> Iterator[dict[int, list[int]]]:
        at, seen = self.first, set()
        while at:
            if at in seen:
                raise TiffError("image directories form a loop")
            seen.add(at)
            n = self.unpack("Q" if self.big else "H", at)
            step, head, inline = (20, 8, 8) if self.big else (12, 2, 4)
            fields = {}
            for i in range(n):
                entry = at + head + i * step
                tag, kind = self.unpack("H", entry), self.unpack("H", entry + 2)
                count = self.unpack("Q" if self.big else "I", entry + 4)
                if kind not in FIELD:
                    continue
                size = struct.calcsize("<" + FIELD[kind]) * count
                place = entry + step - inline
                if size > inline:
                    place = self.unpack("Q" if self.big else "I", place)
                if place + size > len(self.data):
                    raise TiffError("a field points outside the file")
                fields[tag] = list(struct.unpack_from(f"{self.order}{count}{FIELD[kind]}", self.data, place))
            yield fields
            at = self.unpack("Q" if self.big else "I", at + head + n * step)


def _page(f: _File, index: int, tags: dict[int, list[int]]) -> Page:
    def one(tag: int, default: int | None = None) -> int:
        if tags.get(tag):
            return tags[tag][0]
        if default is None:
            raise TiffError(f"tag {tag} is missing")
        return default

    width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    bits, compression, predictor, planar = one(BITS, 1), one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1)
    if bits not in (8, 16, 32, 64) or len(set(tags.get(BITS, [bits]))) > 1:
        raise TiffError(f"samples of {tags.get(BITS)} bits are not supported")
    kind = {1: "u", 2: "i", 3: "f"}.get(one(FORMAT, 1), "u")
    if kind == "f" and bits == 8:
        raise TiffError("8-bit floating point is not supported")
    dtype = np.dtype(f"{f.order}{kind}{bits // 8}" if bits > 8 else "u1")
    tiled = TILE_AT in tags
    if tiled:
        seg_w, seg_h, offsets, sizes = one(TILE_WIDTH), one(TILE_HEIGHT), tags[TILE_AT], tags.get(TILE_SIZE, [])
    else:
        seg_w, seg_h = width, min(one(STRIP_ROWS, height), height) or 1
        offsets, sizes = tags.get(STRIP_AT, []), tags.get(STRIP_SIZE, [])
    if not width or not height or not seg_w or not seg_h or not samples:
        raise TiffError("the page has no area")
    across, down = -(-width // seg_w), -(-height // seg_h)
    planes, depth = (samples, 1) if planar == 2 else (1, samples)
    if len(offsets) < planes * across * down or len(sizes) < len(offsets):
        raise TiffError("segments are missing")
    if compression not in MOST_FROM_BYTE:
        raise TiffError(f"compression {compression} is not supported")
    if width * height * samples * dtype.itemsize > MOST_FROM_BYTE[compression] * sum(min(n, len(f.data)) for n in sizes[: planes * across * down]):
        raise TiffError("the page is larger than its segments can hold")
    image = np.zeros((height, width, samples), dtype)
    for k in range(planes * across * down):
        plane, spot = divmod(k, across * down)
        y, x = spot // across * seg_h, spot % across * seg_w
        rows = seg_h if tiled else min(seg_h, height - y)
        need = rows * seg_w * depth * dtype.itemsize
        raw = decode_segment(f.data[offsets[k] : offsets[k] + sizes[k]], compression, need)
        if len(raw) < need:
            raise TiffError("a segment is too short")
        block = np.frombuffer(raw, dtype, rows * seg_w * depth).reshape(rows, seg_w, depth)
        block = undo_predictor(block, predictor, f.order).view(dtype)
        h, w = min(rows, height - y), min(seg_w, width - x)
        if planar == 2:
            image[y : y + h, x : x + w, plane] = block[:h, :w, 0]
        else:
            image[y : y + h, x : x + w] = block[:h, :w]
    return Page(index, width, height, samples, bits, compression, predictor, tiled, image.tobytes())


def read_tiff(data: bytes) -> Iterator[Page | TiffError]:
    """Pages in directory order.  A page that can't be decoded yields its error; the walk goes on where it can."""
    try:
        f = _File(data)
        for index, tags in enumerate(f.directories()):
            try:
                yield _page(f, index, tags)
            except TiffError as e:
                yield e
    except TiffError as e:
        yield e


# --- writing --------------------------------------------------------------------------------------


def write_tiff(images: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, tile: tuple[int, int] | None = None, strip_rows: int = 64, order: str = "<") -> bytes:
    """A classic TIFF with a page for each (height, width, samples) array of unsigned integers.

    ``tile`` is (width, height), both multiples of 16; without it the page is cut into strips.
    """
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4
    for image in images:
        height, width, samples = image.shape
        dtype = image.dtype.newbyteorder(order)
        seg_w, seg_h = tile or (width, strip_rows)
        offsets, sizes = [], []
        for y in range(0, height, seg_h):
            for x in range(0, width, seg_w):
                block = image[y : y + seg_h, x : x + seg_w]
                if tile:
                    block = np.pad(block, ((0, seg_h - block.shape[0]), (0, seg_w - block.shape[1]), (0, 0)))
                stored = encode_segment(apply_predictor(block, predictor).astype(dtype).tobytes(), compression)
                offsets.append(len(out))
                sizes.append(len(stored))
                out += stored
        bits = image.dtype.itemsize * 8
        tags = [(WIDTH, "I", [width]), (HEIGHT, "I", [height]), (BITS, "H", [bits] * samples), (COMPRESSION, "H", [compression]), (PHOTOMETRIC, "H", [2 if samples == 3 else 1]), (SAMPLES, "H", [samples]), (PLANAR, "H", [1]), (PREDICTOR, "H", [predictor])]
        if tile:
            tags += [(TILE_WIDTH, "I", [seg_w]), (TILE_HEIGHT, "I", [seg_h]), (TILE_AT, "I", offsets), (TILE_SIZE, "I", sizes)]
        else:
            tags += [(STRIP_AT, "I", offsets), (STRIP_ROWS, "I", [seg_h]), (STRIP_SIZE, "I", sizes)]
        entries = []
        for tag, kind, values in sorted(tags):
            packed = struct.pack(f"{order}{len(values)}{kind}", *values)
            if len(packed) > 4:
                place = len(out)
                out += packed + b"\0" * (len(packed) % 2)
                packed = struct.pack(order + "I", place)
            entries.append(struct.pack(order + "HHI", tag, {"H": 3, "I": 4}[kind], len(values)) + packed.ljust(4, b"\0"))
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


# --- Spark ----------------------------------------------------------------------------------------

PAGE_FIELDS = [
    T.StructField("page", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("samples", T.IntegerType()),
    T.StructField("bits", T.IntegerType()),
    T.StructField("compression", T.IntegerType()),
    T.StructField("predictor", T.IntegerType()),
    T.StructField("tiled", T.BooleanType()),
    T.StructField("pixels", T.BinaryType()),
    T.StructField("error", T.StringType()),
]


def tiff_pages(df: DataFrame, content_col: str = "content", keep: list[str] | None = None) -> DataFrame:
    """One row per page of every TIFF in ``content_col``: the ``keep`` columns, then PAGE_FIELDS.

    A page's pixels come in the file's sample type and byte order; equal files give equal rows, an empty
    table none.  ``keep`` defaults to all other columns; names that clash with a page field are kept with the
    prefix ``in_``.  A null, foreign or damaged file gives one row with ``error`` set and null page
    fields; a damaged page gives its error and the pages after it still come.  No shuffle.
    """
    bounded_batches(session_of(df))
    keep = [c for c in df.columns if c != content_col] if keep is None else keep
    taken = {f.name for f in PAGE_FIELDS}
    names = [f"in_{c}" if c in taken else c for c in keep]
    schema = T.StructType([T.StructField(n, df.schema[c].dataType) for n, c in zip(names, keep, strict=True)] + PAGE_FIELDS)
    page_names = [f.name for f in PAGE_FIELDS]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source: list[int] = []
            rows: dict[str, list] = {n: [] for n in page_names}
            for i, content in enumerate(batch.column(len(keep)).to_pylist()):
                for found in read_tiff(content) if content is not None else [TiffError("no content")]:
                    source.append(i)
                    for n in page_names:
                        rows[n].append(str(found) if n == "error" and isinstance(found, TiffError) else getattr(found, n, None))
            kept = [batch.column(k).take(pa.array(source, pa.int32())) for k in range(len(keep))]
            kinds = [pa.int32()] * 7 + [pa.bool_(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(rows[n], k) for n, k in zip(page_names, kinds, strict=True)], names=[*names, *page_names])

    return df.select(*keep, content_col).mapInArrow(decode, schema)


def payload_tiff(payload: bytes, row_bytes: int = 192) -> bytes:
    """``payload``, a positive multiple of ``row_bytes``, as one RGB page of 8-bit samples.

    Codec, predictor and layout follow from the payload's own checksum, so equal payloads give equal
    files.  The four codecs have the same share, as have strips and tiles, and predictors 1 and 2 for LZW
    and deflate, the codecs for which the format defines one.
    """
    pick = zlib.crc32(payload)
    image = np.frombuffer(payload, np.uint8).reshape(-1, row_bytes // 3, 3)
    compression = (RAW, LZW, PACKBITS, DEFLATE)[pick % 4]
    predictor = 1 + (pick >> 2) % 2 if compression in (LZW, DEFLATE) else 1
    return write_tiff([image], compression, predictor, (row_bytes // 3, 16) if (pick >> 3) % 2 else None)
