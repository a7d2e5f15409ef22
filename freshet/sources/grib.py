"""GRIB2 messages as arrays, for ``tables.grids(spark, path, decode=grib.gzipped)``: regular grids with simple (5.0) or PNG (5.41) packing."""

from __future__ import annotations

import gzip
import struct
import zlib

import numpy as np


def _signed(raw: bytes) -> int:
    """Sign and magnitude, as the format has it."""
    n = int.from_bytes(raw, "big")
    top = 1 << (8 * len(raw) - 1)
    return top - n if n >= top else n


def _numbers(raw: bytes, n: int, bits: int) -> np.ndarray:
    """n whole numbers of so many bits each."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f">u{bits // 8}", n).astype("f8")
    flat = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits).reshape(n, bits)
    return flat @ (2.0 ** np.arange(bits)[::-1])


def png(data: bytes) -> tuple[np.ndarray, int]:
    """The bytes of an image's pixels (rows, bytes), and bits a pixel."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG image")
    at, packed, head = 8, b"", None
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IHDR":
            head = struct.unpack_from(">IIBBBBB", data, at + 8)
        elif kind == b"IDAT":
            packed += data[at + 8 : at + 8 + size]
        at += 12 + size
    width, height, depth, colour, _, _, interlaced = head
    if interlaced or colour not in (0, 2, 6):
        raise ValueError("interlaced or palette images aren't used in messages")
    bits = depth * {0: 1, 2: 3, 6: 4}[colour]
    step, line = max(1, bits // 8), -(-width * bits // 8)
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, line + 1)
    out, above = np.zeros((height, line), np.uint8), np.zeros(line, np.uint8)
    for k, (way, row) in enumerate(zip(raw[:, 0].tolist(), raw[:, 1:], strict=True)):
        if way == 1 and line % step == 0:  # sums along the row
            own = np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint64).astype(np.uint8).ravel()
        elif way in (0, 2):
            own = row + above if way == 2 else row
        else:
            own = np.array(_filtered(way, row.tolist(), above.tolist(), step), np.uint8)
        out[k] = above = own
    return out, bits


def _filtered(way: int, row: list[int], above: list[int], step: int) -> list[int]:
    """The image format's filters that depend on the pixel before."""
    out: list[int] = []
    for i, x in enumerate(row):
        a, c = (out[i - step], above[i - step]) if i >= step else (0, 0)
        b = above[i]
        if way == 4:
            near = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
        else:
            near = a if way == 1 else (a + b) // 2
        out.append((x + near) % 256)
    return out


def decode(data: bytes) -> np.ndarray:
    """The first message's field, rows from north to south as stored; points that the bit map leaves out are NaN."""
    if data[:4] != b"GRIB" or data[7] != 2:
        raise ValueError("no GRIB message of edition 2")
    at, shape, packing, mask = 16, None, None, None
    while data[at : at + 4] != b"7777":
        size, number = struct.unpack_from(">IB", data, at)
        own = data[at : at + size]
        if number == 3:
            if struct.unpack_from(">H", own, 12)[0] != 0:
                raise ValueError("the grid is not regular in longitude and latitude")
            columns, rows = struct.unpack_from(">II", own, 30)
            shape = (rows, columns)
        elif number == 5:
            n, template, base = struct.unpack_from(">IHf", own, 5)
            if template not in (0, 41):
                raise ValueError(f"packing 5.{template} is not at hand")
            packing = n, template, base, _signed(own[15:17]), _signed(own[17:19]), own[19]
        elif number == 6 and own[5] == 0:
            mask = np.unpackbits(np.frombuffer(own[6:], np.uint8), count=shape[0] * shape[1]).astype(bool)
        elif number == 7:
            n, template, base, binary, decimal, bits = packing
            raw = own[5:]
            if bits == 0:
                x = np.zeros(n)
            elif template == 41:
                pixels, bits = png(raw)
                x = np.concatenate([_numbers(r.tobytes(), len(r) * 8 // bits, bits) for r in pixels])[:n] if bits not in (24,) else (pixels.reshape(-1, 3).astype("f8") @ [65536.0, 256.0, 1.0])[:n]
            else:
                x = _numbers(raw, n, bits)
            values = (base + x * 2.0**binary) / 10.0**decimal
            if mask is not None:
                full = np.full(mask.size, np.nan)
                full[mask] = values
                values = full
            return values.reshape(shape)
        at += size
    raise ValueError("a message without data")


def gzipped(data: bytes) -> np.ndarray:
    return decode(gzip.decompress(data))


def encode(field: np.ndarray, decimal: int = 1, as_png: bool = False) -> bytes:
    """A message with a field in simple or PNG packing, to so many decimal places, in 16 bits."""
    rows, columns = field.shape
    base = float(np.float32(np.floor(field.min() * 10**decimal)))
    x = np.rint(field * 10**decimal - base).astype(">u2")
    section = lambda number, body: struct.pack(">IB", len(body) + 5, number) + body
    grid = bytearray(67)
    struct.pack_into(">I", grid, 1, rows * columns)
    struct.pack_into(">II", grid, 25, columns, rows)
    body = x.tobytes()
    if as_png:
        chunk = lambda kind, d: struct.pack(">I", len(d)) + kind + d + struct.pack(">I", zlib.crc32(kind + d))
        lines = b"".join(b"\x00" + r.tobytes() for r in x)
        body = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", columns, rows, 16, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
    packing = struct.pack(">IHfHHBB", rows * columns, 41 if as_png else 0, base, 0, decimal, 16, 0)
    parts = section(1, bytes(16)) + section(3, bytes(grid)) + section(4, bytes(29)) + section(5, packing) + section(6, b"\xff") + section(7, body) + b"7777"
    return b"GRIB\x00\x00\xd1\x02" + struct.pack(">Q", 16 + len(parts)) + parts
