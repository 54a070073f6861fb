import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from anchorline.llm import gif


def slow_lzw(stream, code_size):
    """Bit by bit, as the specification describes it."""
    bits = [b >> k & 1 for b in stream for k in range(8)]
    clear, end = 1 << code_size, (1 << code_size) + 1
    at, width, table, last, out = 0, code_size + 1, None, None, b""
    while True:
        code = sum(bits[at + k] << k for k in range(width))
        at += width
        if code == clear:
            table = {i: bytes([i]) for i in range(clear)} | {clear: b"", end: b""}
            width, last = code_size + 1, None
            continue
        if code == end:
            return out
        entry = table[code] if code in table else last + last[:1]
        if last is not None and len(table) < 4096:
            table[len(table)] = last + entry[:1]
        if len(table) == 1 << width and width < 12:
            width += 1
        out, last = out + entry, entry


@pytest.mark.parametrize("n", [0, 1, 2, 3, 400, 9000, 40000])
@pytest.mark.parametrize("most", [0, 3, 255])
def test_lzw_round_trip(n, most):
    rng = random.Random(n + most)
    data = bytes(rng.randint(0, most) for _ in range(n))
    stream = gif.lzw_compress(data)
    assert gif.lzw_expand(stream, 8, max(1, n)) == data
    assert slow_lzw(stream, 8) == data


def test_small_code_sizes_and_deferred_clear():
    rng = random.Random(1)
    for size in (2, 3, 5):
        data = bytes(rng.randrange(1 << size) for _ in range(20000))
        assert slow_lzw(gif.lzw_compress(data, size), size) == data
        assert gif.lzw_expand(gif.lzw_compress(data, size), size, 20000) == data


def block(data):
    return gif._blocks(data)


def image(pixels, w, h, left=0, top=0, delay=5, disposal=1, clear=None, local=b"", interlaced=False):
    control = struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (clear is not None), delay, clear or 0, 0)
    flags = (0x80 | 1 if local else 0) | (0x40 if interlaced else 0)
    return control + struct.pack("<BHHHHB", 0x2C, left, top, w, h, flags) + local + b"\x02" + block(gif.lzw_compress(bytes(pixels), 2))


def file(w, h, *images):
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    return b"GIF89a" + struct.pack("<HHBBB", w, h, 0x81, 0, 0) + palette + b"".join(images) + b"\x3b"


RED, GREEN, BLUE, BLACK = 0xFFFF0000, 0xFF00FF00, 0xFF0000FF, 0xFF000000


def test_disposal_transparency_palettes_and_times():
    media = file(
        2, 2,
        image([1, 1, 1, 1], 2, 2, delay=7),
        image([2], 1, 1, left=1, disposal=3),
        image([3, 0], 2, 1, top=1, clear=0, disposal=2),
        image([1], 1, 1, local=bytes([9, 9, 9, 8, 8, 8, 0, 0, 0, 0, 0, 0])),
    )
    frames = list(gif.decode(media))
    assert [f.delay_ms for f in frames] == [70, 50, 50, 50]
    assert [f.canvas.ravel().tolist() for f in frames] == [
        [RED, RED, RED, RED], [RED, GREEN, RED, RED],
        [RED, RED, BLUE, RED],  # the green pixel is taken back
        [0xFF080808, RED, 0, 0],  # the last rectangle is cleared
    ]
    assert gif.histogram(frames[3].canvas).nonzero()[0].tolist() == [0, 48, 64]


def test_interlaced_rows():
    rows = [0, 8, 4, 2, 6, 1, 3, 5, 7]
    got = next(gif.decode(file(1, 9, image([r % 4 for r in rows], 1, 9, interlaced=True)))).canvas.ravel()
    assert got.tolist() == [[BLACK, RED, GREEN, BLUE][r % 4] for r in range(9)]


def test_frames_operator(spark):
    good = file(2, 1, image([1, 2], 2, 1), image([3, 3], 2, 1))
    rows = [(1, good), (2, None), (3, b"no gif"), (4, good[:60]), (5, b""), (6, good[:-1])]
    got = sorted(((r.media_id, -1 if r.frame is None else r.frame, r.delay_ms, r.error) for r in gif.frames(spark.createDataFrame(rows, "media_id long, media binary")).collect()), key=str)
    assert [g[:3] for g in got if g[3] is None] == [(1, 0, 50), (1, 1, 50), (4, 0, 50), (6, 0, 50), (6, 1, 50)]
    assert {g[0] for g in got if g[3]} == {3, 4, 5, 6}
    assert gif.frames(spark.createDataFrame([], "media_id long, media binary")).count() == 0


def test_oversize_is_an_error_row(spark):
    huge = b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0) + b"\x3b"
    wide = file(2, 1, image([1, 2], 2, 1), image([1], 40000, 40000))
    deep = file(2, 1, image([1, 2], 2, 1).replace(b"\x00\x02", b"\x00\x09", 1))
    fine = file(2, 1, image([1, 2], 2, 1))
    rows = [(1, huge), (2, wide), (3, deep), (4, fine), (4, fine)]
    got = sorted((r.media_id, -1 if r.frame is None else r.frame, r.error is not None) for r in gif.frames(spark.createDataFrame(rows, "media_id long, media binary")).collect())
    assert got == [(1, -1, True), (2, -1, True), (2, 0, False), (3, -1, True), (4, 0, False), (4, 0, False)]
    with pytest.raises(ValueError):
        next(gif.decode(fine, most_pixels=1))


def test_texts_as_media(spark):
    texts = ["", "a", "x" * 192, "é" * 100, "long text \n" * 30000, None, "a"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, None, "y"), (None, "n", "z")]
    got = {(r.doc_id, r.payload_sha256): r for r in gif.op2(spark.createDataFrame(rows, "doc_id long, text string, media string")).collect()}
    for i, t, _ in rows:
        data = (t or "").encode()
        payload = data + b" " * (-len(data) % 192 if data else 192)
        r = got[i, hashlib.sha256(payload).hexdigest()]
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(data), len(payload), zlib.crc32(payload[-16:]))
        media = gif.encode(payload, str(len(data)).encode())
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    assert gif.op2(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert np.array_equal(np.array(gif.histogram(np.array([[RED, 0]], dtype=np.uint32)).nonzero()[0]), [48, 64])
