"""Animated GIF columns: writing, decoding and colour histograms.

``decode`` reads a GIF file as the public specification has it: logical screen,
global and local palettes, LZW code streams, interlacing, transparency, frame
delays and the disposal of frames, and yields the composed canvas of every frame.
``frames`` is the DataFrame operator over a binary column; ``encode`` writes bytes
as grey frames, which ``op2`` uses to store texts.

Defined results: null media gives no frames; media that is no GIF, breaks off or has
a canvas of more than ``PIXELS`` gives its whole frames and one row with ``error``
set; an empty table gives no rows.  A repeated row gives its frames again.  A null or
empty text is stored as one row of blanks, a very long one as many frames, of which
one at a time is composed; columns other than the two that are read are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Pixels in a row and rows in a frame of what ``encode`` writes.
WIDTH, ROWS = 192, 256
TOP = 4096  # codes of twelve bits
#: Most pixels of a canvas or frame that is decoded, four bytes each.
PIXELS = 1 << 26
#: A palette in which every value is its own grey.
GREYS = bytes(v for i in range(256) for v in (i, i, i))

FRAMES = "media_id long, frame int, delay_ms int, disposal int, width int, height int, histogram array<int>, error string"


# ---- LZW ----------------------------------------------------------------------


@functools.cache
def _widths(code_size: int) -> np.ndarray:
    """Bits of the codes that follow a clear code; a code's width counts the entries made before it is read."""
    free = (1 << code_size) + 2 + np.maximum(np.arange(TOP + 2) - 1, 0)
    return np.minimum(12, np.floor(np.log2(free)).astype(np.int64) + 1)


@functools.cache
def _places(code_size: int) -> np.ndarray:
    """Bits before each of those codes."""
    return np.concatenate([[0], np.cumsum(_widths(code_size))])


@functools.cache
def _literals(code_size: int) -> tuple[bytes, ...]:
    return (*(bytes([i & 255]) for i in range(1 << code_size)), b"", b"")


def lzw_compress(data: bytes, code_size: int = 8) -> bytes:
    """The code stream of GIF: clear first, codes of growing width, clear when the table is full, end."""
    clear, end = 1 << code_size, (1 << code_size) + 1
    codes: list[int] = [clear << 8]  # codes are held shifted, so that a key is one operation
    starts = [0]  # where clear codes are
    table: dict[int, int] = {}
    get, put = table.get, codes.append
    first, full = (end + 1) << 8, TOP << 8
    free = first
    if data:
        prefix = data[0] << 8
        for byte in data[1:]:
            key = prefix | byte
            code = get(key)
            if code is not None:
                prefix = code
                continue
            put(prefix)
            prefix = byte << 8
            if free < full:
                table[key] = free
                free += 256
            else:
                starts.append(len(codes))
                put(clear << 8)
                table.clear()
                free = first
        put(prefix)
    put(end << 8)
    schedule = _widths(code_size)
    widths = [schedule[:1]]
    for a, b in zip(starts, [*starts[1:], len(codes) - 1]):
        widths.append(schedule[: b - a])
    return _to_bits(np.array(codes, dtype=np.int64) >> 8, np.concatenate(widths))


def _to_bits(codes: np.ndarray, widths: np.ndarray) -> bytes:
    ends = np.cumsum(widths)
    begin = ends - widths
    out = np.zeros(int(ends[-1]) // 8 + 4, dtype=np.int64)
    shifted = codes << (begin % 8)
    for k in range(3):
        out += np.bincount(begin // 8 + k, weights=(shifted >> (8 * k)) & 255, minlength=len(out)).astype(np.int64)
    return out[: (int(ends[-1]) + 7) // 8].astype(np.uint8).tobytes()


def lzw_expand(stream: bytes, code_size: int, limit: int) -> bytes:
    """At most ``limit`` pixels of a code stream; ValueError if it breaks off or is no such stream."""
    clear, end = 1 << code_size, (1 << code_size) + 1
    bits = np.frombuffer(stream + b"\0\0\0\0", dtype=np.uint8)
    total, at = 8 * len(stream), 0
    literals, schedule = _literals(code_size), _places(code_size)
    out: list[bytes] = []
    made = 0
    table, last, step = list(literals), None, 0  # step: codes since the last clear
    while made < limit:
        # all codes up to the next clear or end, as far as their widths are known
        if step < TOP:
            places = at + schedule[step:-1] - schedule[step]
            ends = at + schedule[step + 1 :] - schedule[step]
        else:
            places = at + 12 * np.arange(TOP)
            ends = places + 12
        n = int(np.searchsorted(ends, total, side="right"))
        if not n:
            raise ValueError("the code stream breaks off")
        places, ends = places[:n], ends[:n]
        byte = places >> 3
        # only what this stretch covers is read
        codes = (bits[byte].astype(np.int64) | bits[byte + 1].astype(np.int64) << 8 | bits[byte + 2].astype(np.int64) << 16) >> (places & 7) & ((1 << (ends - places)) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        upto = int(stops[0]) if len(stops) else n
        here = codes[:upto].tolist()
        if last is None and here:
            if here[0] >= clear:
                raise ValueError("a code that is not in the table")
            last = literals[here.pop(0)]
            out.append(last)
            made += 1
        known, before = len(table), len(out)
        for code in here:
            if code < known:
                entry = table[code]
            elif code == known < TOP:
                entry = last + last[:1]
            else:
                raise ValueError("a code that is not in the table")
            if known < TOP:
                table.append(last + entry[:1])
                known += 1
            last = entry
            out.append(entry)
        made += sum(map(len, out[before:]))
        if len(stops):
            at = int(ends[upto])
            if int(codes[upto]) == end:
                break
            table, last, step = list(literals), None, 0
        else:
            at, step = int(ends[-1]), step + n
    return b"".join(out)[:limit]


# ---- files ----------------------------------------------------------------------


def _blocks(data: bytes) -> bytes:
    """Data sub-blocks of at most 255 bytes and the terminator."""
    return b"".join(bytes([len(part := data[i : i + 255])]) + part for i in range(0, len(data), 255)) + b"\0"


def encode(payload: bytes, comment: bytes = b"", delay_cs: int = 10) -> bytes:
    """Bytes as grey pixels, a row of WIDTH each, ROWS to a frame; the length must be a multiple of WIDTH."""
    rows = len(payload) // WIDTH
    if not rows or len(payload) % WIDTH:
        raise ValueError(f"the payload must be a positive multiple of {WIDTH} bytes")
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, min(rows, ROWS), 0xF7, 0, 0), GREYS]
    out.append(b"\x21\xfe" + _blocks(comment))
    for top in range(0, rows, ROWS):
        height = min(ROWS, rows - top)
        part = payload[top * WIDTH : (top + height) * WIDTH]
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, delay_cs, 0, 0))
        out.append(struct.pack("<BHHHHB", 0x2C, 0, 0, WIDTH, height, 0) + b"\x08" + _blocks(lzw_compress(part)))
    return b"".join([*out, b"\x3b"])


class Frame:
    """A composed frame: its timing, its own rectangle and the canvas, colours as 0xAARRGGBB."""

    def __init__(self, delay_ms: int, disposal: int, box: tuple[int, int, int, int], canvas: np.ndarray, comments: list[bytes]):
        self.delay_ms, self.disposal, self.box, self.canvas, self.comments = delay_ms, disposal, box, canvas, comments


def decode(media: bytes, most_pixels: int = PIXELS) -> Iterator[Frame]:
    """The frames in their order; ValueError for what is no whole GIF, or has a canvas or frame of more than ``most_pixels``."""
    if media[:6] not in (b"GIF87a", b"GIF89a") or len(media) < 13:
        raise ValueError("no GIF signature")
    width, height, flags, _, _ = struct.unpack_from("<HHBBB", media, 6)
    at = 13

    def palette(flags: int) -> np.ndarray:
        nonlocal at
        n = 2 << (flags & 7)
        raw = np.frombuffer(media, dtype=np.uint8, count=3 * n, offset=at).astype(np.uint32)
        at += 3 * n
        return 0xFF000000 | raw[::3] << 16 | raw[1::3] << 8 | raw[2::3]

    def sub_blocks() -> bytes:
        nonlocal at
        parts = []
        while n := media[at]:
            if at + 1 + n >= len(media):
                raise ValueError("a block breaks off")
            parts.append(media[at + 1 : at + 1 + n])
            at += n + 1
        at += 1
        return b"".join(parts)

    try:
        shared = palette(flags) if flags & 0x80 else None
        if width * height > most_pixels:
            raise ValueError("a canvas above the limit")
        canvas = np.zeros((height, width), dtype=np.uint32)
        control, comments = (0, 0, None), []  # disposal, delay in 1/100 s, transparent index
        while (kind := media[at]) != 0x3B:
            at += 1
            if kind == 0x21:
                label, at = media[at], at + 1
                data = sub_blocks()
                if label == 0xF9 and len(data) >= 4:
                    control = (data[0] >> 2 & 7, struct.unpack_from("<H", data, 1)[0], data[3] if data[0] & 1 else None)
                elif label == 0xFE:
                    comments.append(data)
                continue
            if kind != 0x2C:
                raise ValueError("an unknown block")
            left, top, w, h, local = struct.unpack_from("<HHHHB", media, at)
            at += 9
            colours = palette(local) if local & 0x80 else shared
            code_size = media[at]
            at += 1
            if colours is None or not 1 <= code_size <= 8:
                raise ValueError("a frame without colours")
            if w * h > most_pixels:
                raise ValueError("a frame above the limit")
            pixels = np.frombuffer(lzw_expand(sub_blocks(), code_size, w * h), dtype=np.uint8)
            if len(pixels) < w * h:
                raise ValueError("a frame breaks off")
            pixels = pixels.reshape(h, w)
            if local & 0x40:
                order = [y for first, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(first, h, step)]
                pixels = pixels[np.argsort(np.array(order))]
            disposal, delay, clear_index = control
            before = canvas.copy() if disposal == 3 else None
            area = canvas[top : top + h, left : left + w]
            pixels = pixels[: area.shape[0], : area.shape[1]]
            if int(pixels.max(initial=0)) >= len(colours):
                raise ValueError("a colour that is not in the palette")
            painted = colours[pixels]
            area[...] = painted if clear_index is None else np.where(pixels == clear_index, area, painted)
            yield Frame(10 * delay, disposal, (left, top, w, h), canvas.copy(), comments)
            if disposal == 2:
                area[...] = 0
            elif disposal == 3:
                canvas = before
            control = (0, 0, None)
    except (IndexError, struct.error) as error:
        raise ValueError("the file breaks off") from error


def histogram(canvas: np.ndarray) -> np.ndarray:
    """Counts in 64 bins, four levels each of red, green and blue, and of transparent pixels."""
    bins = (canvas >> 22 & 3) << 4 | (canvas >> 14 & 3) << 2 | (canvas >> 6 & 3)
    return np.bincount(np.where(canvas >> 24 == 0, 64, bins).ravel(), minlength=65)


def frames(media: DataFrame, most_pixels: int = PIXELS) -> DataFrame:
    """A row for each frame of ``media`` (media_id, media), with times and the canvas's colour histogram.

    A file that breaks off has its whole frames and then a row with ``error``, as has
    one with a canvas or frame of more than ``most_pixels``, which bounds a task's memory.
    """
    common.on_workers(media.sparkSession)
    names = [f.split()[0] for f in FRAMES.split(", ")]
    schema = pa.schema([("media_id", pa.int64()), *((n, pa.int32()) for n in names[1:6]), ("histogram", pa.list_(pa.int32())), ("error", pa.string())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 50):
            rows = []
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if data is None:
                    continue
                try:
                    for k, f in enumerate(decode(data, most_pixels)):
                        rows.append((i, k, f.delay_ms, f.disposal, f.box[2], f.box[3], histogram(f.canvas), None))
                except ValueError as error:
                    rows.append((i, None, None, None, None, None, None, str(error)))
            if rows:
                yield from common.emit(schema, list(zip(*rows)))

    return media.select(F.col("media_id").cast("long"), F.col("media").cast("binary")).mapInArrow(of, FRAMES)


# ---- texts as media --------------------------------------------------------------

STORED = pa.schema([("doc_id", pa.int64()), ("media", pa.binary())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("n_frames", pa.int64()), ("duration_ms", pa.int64())])
DIGEST_DDL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, duration_ms long"


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, media): every whole text, padded with blanks, as a GIF; its length is the file's comment."""
    common.on_workers(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 100):
            out = []
            for text in batch.column(1).to_pylist():
                data = (text or "").encode("utf-8", "surrogatepass")
                out.append(encode(data + b" " * (-len(data) % WIDTH or (0 if data else WIDTH)), str(len(data)).encode()))
            yield from common.emit(STORED, [batch.column(0), out])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, "doc_id long, media binary")


def read_back(stored: DataFrame) -> DataFrame:
    """What the stored media hold, from their composed frames."""
    common.on_workers(stored.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 100):
            rows = []
            for doc_id, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts, counts, duration, note = [], np.zeros(65, dtype=np.int64), 0, b"0"
                for f in decode(media):
                    left, top, w, h = f.box
                    area = f.canvas[top : top + h, left : left + w]
                    parts.append((area & 255).astype(np.uint8).tobytes())
                    counts += histogram(area)
                    duration, note = duration + f.delay_ms, f.comments[0]
                payload = b"".join(parts)
                feature = ",".join(map(str, counts[[0, 21, 42, 63, 64]].tolist()))
                rows.append((doc_id, int(note), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(parts), duration))
            yield from common.emit(DIGEST, list(zip(*rows)))

    return stored.mapInArrow(of, DIGEST_DDL)


def op2(docs: DataFrame) -> DataFrame:
    return read_back(common.saved(store(docs), "media", compression="none"))
