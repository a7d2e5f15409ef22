"""Shapefiles as a Python data source: ``spark.read.format("shp").load("x.shp")`` gives the attributes of ``x.dbf`` and ``geometry`` as well-known binary.

Points and polygons (with or without Z and M, which are left out) are read; rings that run clockwise are outlines, the others holes of the outline
around them. Tasks read ranges of records by ``x.shx``. Deleted attribute rows are left out. The files must be readable at the
same path by driver and executors.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from freshet.functions import wkb
from freshet.session import ship
from freshet.sources.files import local, ranges, whole

#: Fixed values of the format.
MAGIC, VERSION, HEADER = 9994, 1000, 100
POINTS, POLYGONS = (1, 11, 21), (5, 15, 25)


def fields(dbf: str) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    """Rows, bytes of the header, bytes of a row, and each field's name, type, width and decimals."""
    with open(dbf, "rb") as f:
        n, start, width = struct.unpack("<IHH", f.read(12)[4:])
        f.seek(32)
        out = []
        while (d := f.read(32)) and d[0] != 0x0D:
            out.append((d[:11].split(b"\x00")[0].decode(), chr(d[11]), d[16], d[17]))
    return n, start, width, out


def kind(type_: str, width: int, decimals: int) -> str:
    if type_ in "NF":
        return "long" if type_ == "N" and decimals == 0 and width < 19 else "double"
    return "boolean" if type_ == "L" else "string"


def value(raw: bytes, type_: str):
    text = raw.decode("utf-8", "replace").strip("\x00 ")
    if type_ == "long":
        return int(text) if text and "*" not in text else None
    if type_ == "double":
        return float(text) if text and "*" not in text else None
    if type_ == "boolean":
        return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
    return text or None


def geometry(content: bytes) -> bytes | None:
    (type_,) = struct.unpack_from("<i", content)
    if type_ == 0:
        return None
    if type_ in POINTS:
        return wkb.point(*struct.unpack_from("<2d", content, 4))
    if type_ not in POLYGONS:
        raise ValueError(f"shape type {type_} is neither point nor polygon")
    n_parts, n_points = struct.unpack_from("<2i", content, 36)
    starts = [*struct.unpack_from(f"<{n_parts}i", content, 44), n_points]
    xy = np.frombuffer(content, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
    rings = [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    outlines = [[r[::-1]] for r in rings if wkb.ring_area(r[:-1]) < 0] or [[r] for r in rings[:1]]
    for hole in (r for r in rings if wkb.ring_area(r[:-1]) > 0 and len(outlines) + len(rings) > 2):
        middle = (hole[:1] + hole[1:2]) / 2
        holder = next((o for o in outlines if wkb.contains(wkb.polygon(list(map(tuple, o[0]))), middle[:, 0], middle[:, 1])[0]), None)
        if holder is not None:
            holder.append(hole[::-1])
    shapes = [[list(map(tuple, r)) for r in o] for o in outlines]
    return wkb.polygon(*shapes[0]) if len(shapes) == 1 else wkb.multipolygon([[np.array(r) for r in o] for o in shapes])


class Shapefile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shp"

    def schema(self) -> str:
        own = fields(local(self.options["path"])[:-4] + ".dbf")[3]
        return ", ".join([*(f"`{n}` {kind(t, w, d)}" for n, t, w, d in own), "geometry binary"])

    def reader(self, schema) -> DataSourceReader:
        return ShapeReader(local(self.options["path"])[:-4], int(self.options.get("parts", "4")))


class ShapeReader(DataSourceReader):
    def __init__(self, stem: str, parts: int):
        self.stem, self.parts = stem, parts

    def partitions(self) -> Sequence[InputPartition]:
        return [InputPartition(x) for x in ranges(fields(f"{self.stem}.dbf")[0], self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        first, last = partition.value
        _, start, width, own = fields(f"{self.stem}.dbf")
        with open(f"{self.stem}.shx", "rb") as index, open(f"{self.stem}.shp", "rb") as shapes, open(f"{self.stem}.dbf", "rb") as rows:
            index.seek(HEADER + 8 * first)
            rows.seek(start + width * first)
            for _ in range(first, last):
                offset, length = struct.unpack(">2i", index.read(8))
                shapes.seek(2 * offset + 8)
                content, row = shapes.read(2 * length), rows.read(width)
                if row[:1] == b"*":
                    continue
                at, out = 1, []
                for _, t, w, d in own:
                    out.append(value(row[at : at + w], kind(t, w, d)))
                    at += w
                yield (*out, geometry(content))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(Shapefile)


def write(path: str, columns: Sequence[tuple[str, str, int, int]], rows: Sequence[tuple], shape_type: int = 5) -> None:
    """A small shapefile: rows of values and, last, a well-known binary polygon (5) or an (x, y) pair (1)."""
    stem = local(path)[:-4]
    contents = []
    for *_, g in rows:
        if shape_type == 1:
            contents.append(struct.pack("<i2d", 1, *g))
            continue
        rings = [r if (wkb.ring_area(r) < 0) == (k == 0) else r[::-1] for shape in wkb.parts(g) for k, r in enumerate(shape)]
        rings = [r if (r[0] == r[-1]).all() else np.vstack([r, r[:1]]) for r in rings]
        starts = np.cumsum([0, *(len(r) for r in rings)])
        contents.append(struct.pack("<i4d2i", 5, *wkb.bounds(g), len(rings), starts[-1]) + struct.pack(f"<{len(rings)}i", *starts[:-1]) + np.vstack(rings).astype("<f8").tobytes())
    offsets = np.cumsum([HEADER, *(len(c) + 8 for c in contents)])
    head = lambda size: struct.pack(">7i", MAGIC, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", VERSION, shape_type, *[0.0] * 8)
    with whole(f"{stem}.shp") as a, open(a, "wb") as f:
        f.write(head(int(offsets[-1])) + b"".join(struct.pack(">2i", k + 1, len(c) // 2) + c for k, c in enumerate(contents)))
    with whole(f"{stem}.shx") as a, open(a, "wb") as f:
        f.write(head(HEADER + 8 * len(contents)) + b"".join(struct.pack(">2i", int(o) // 2, len(c) // 2) for o, c in zip(offsets, contents, strict=False)))
    with whole(f"{stem}.dbf") as a, open(a, "wb") as f:
        width = 1 + sum(c[2] for c in columns)
        f.write(struct.pack("<4BIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(columns), width))
        f.write(b"".join(struct.pack("<11sc4xBB14x", n.encode(), t.encode(), w, d) for n, t, w, d in columns) + b"\x0d")
        for *values, _ in rows:
            cells = ["" if v is None else f"{v:.{d}f}" if t in "NF" else str(v) for v, (_, t, _, d) in zip(values, columns, strict=True)]
            f.write(b" " + b"".join((c.rjust(w) if t in "NF" else c.ljust(w)).encode()[:w] for c, (_, t, w, _) in zip(cells, columns, strict=True)))
