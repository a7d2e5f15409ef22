"""NetCDF classic files (versions 1, 2 and 5) as a Python data source, and CF event cubes as such files.

``spark.read.format("netcdf").option("variables", "a,b").load(path)`` gives one row for each place in the grid of the named variables, which share their
dimensions: a column a dimension (the coordinate variable's value, else the number from 0), then the variables. Fill values are null, packed
values are scaled, character arrays are text. The file must be readable at the same path by driver and executors; tasks read ranges of the first dimension.
Files of the HDF5-based version 4 need conversion.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from freshet.session import ship
from freshet.sources.files import batch, local, ranges, spark_type, whole

#: Fixed values of the format: tags of lists, and types by number.
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}


@dataclass
class Variable:
    name: str
    dims: list[str]
    shape: list[int]
    attributes: dict
    dtype: np.dtype
    begin: int
    stride: int  # bytes from one entry of the first dimension to the next


class File:
    """The header of a file; values are read when asked for."""

    def __init__(self, path: str):
        self.path = local(path)
        with open(self.path, "rb") as f:
            self.f = f
            magic = f.read(4)
            if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
                raise ValueError(f"{path} is no NetCDF file of the classic kind")
            self.version = magic[3]
            self.records = self._count()
            self.dims = dict(self._list(DIMENSIONS, lambda: (self._name(), self._count())))
            self.attributes = self._attributes()
            found = self._list(VARIABLES, self._variable)
        names, lengths = list(self.dims), list(self.dims.values())
        grows = lambda ids: bool(ids) and lengths[ids[0]] == 0
        sizes = [(np.prod([lengths[d] for d in ids[1:]], dtype=int) * dtype.itemsize) for _, ids, _, dtype, _ in found if grows(ids)]
        record = int(sizes[0]) if len(sizes) == 1 else int(sum(-(-s // 4) * 4 for s in sizes))
        self.variables = {}
        for name, ids, attributes, dtype, begin in found:
            shape = [self.records if k == 0 and lengths[d] == 0 else lengths[d] for k, d in enumerate(ids)]
            stride = record if grows(ids) else int(np.prod(shape[1:], dtype=int)) * dtype.itemsize
            self.variables[name] = Variable(name, [names[d] for d in ids], shape, attributes, dtype, begin, stride)

    def _int(self, size: int = 4) -> int:
        return int.from_bytes(self.f.read(size), "big")

    def _count(self) -> int:
        return self._int(8 if self.version == 5 else 4)

    def _name(self) -> str:
        n = self._count()
        return self.f.read(-(-n // 4) * 4)[:n].decode()

    def _list(self, tag: int, read) -> list:
        got, n = self._int(), self._count()
        if got not in (0, tag) or (got == 0 and n):
            raise ValueError("damaged NetCDF header")
        return [read() for _ in range(n)]

    def _attributes(self) -> dict:
        def one():
            name, kind, n = self._name(), self._int(), self._count()
            dtype = np.dtype(TYPES[kind])
            raw = self.f.read(-(-n * dtype.itemsize // 4) * 4)[: n * dtype.itemsize]
            values = np.frombuffer(raw, dtype)
            return name, raw.decode() if kind == 2 else values[0].item() if n == 1 else values.tolist()

        return dict(self._list(ATTRIBUTES, one))

    def _variable(self) -> tuple:
        name = self._name()
        ids = [self._count() for _ in range(self._count())]
        attributes, kind = self._attributes(), self._int()
        self._count()
        return name, ids, attributes, np.dtype(TYPES[kind]), self._int(4 if self.version == 1 else 8)

    def values(self, name: str, first: int = 0, last: int | None = None) -> np.ndarray:
        """Values from one to another entry of the first dimension: numbers as they are meant, or text."""
        v = self.variables[name]
        last = (v.shape[0] if v.shape else 1) if last is None else last
        inner = v.shape[1:]
        size = int(np.prod(inner, dtype=int)) * v.dtype.itemsize
        with open(self.path, "rb") as f:
            f.seek(v.begin + first * v.stride)
            raw = f.read(max(0, (last - first) * v.stride)) if v.stride == size else b"".join((f.seek(v.begin + k * v.stride), f.read(size))[1] for k in range(first, last))
        got = np.frombuffer(raw[: (last - first) * size], v.dtype).reshape([last - first, *inner] if v.shape else [])
        if v.dtype.kind == "S":
            return np.array([bytes(x).rstrip(b"\x00 ").decode() for x in got.reshape(-1, got.shape[-1])], object).reshape(got.shape[:-1])
        plain, a = got.astype(got.dtype.newbyteorder("=")), v.attributes
        if {"_FillValue", "scale_factor", "add_offset", "missing_value"} & a.keys() or plain.dtype.kind == "f":
            real = plain.astype("f8")
            for k in ("_FillValue", "missing_value"):
                if k in a:
                    real[plain == a[k]] = np.nan
            return real * a.get("scale_factor", 1.0) + a.get("add_offset", 0.0)
        return plain.astype("i8")


def rows(file: File, names: Sequence[str], first: int, last: int) -> list[np.ndarray]:
    """The columns of a range of the first dimension."""
    values = [file.values(n, first, last) for n in names]
    grid = np.indices(values[0].shape)
    out = []
    for k, d in enumerate(dims_of(file, names)):
        at = grid[k].ravel() + (first if k == 0 else 0)
        out.append(file.values(d)[at] if d in file.variables else at)
    return out + [v.ravel() for v in values]


def dims_of(file: File, names: Sequence[str]) -> list[str]:
    """The dimensions that the variables share; the length of texts is none."""
    of = {tuple(v.dims[:-1] if (v := file.variables[n]).dtype.kind == "S" else file.variables[n].dims) for n in names}
    if len(of) != 1:
        raise ValueError(f"{list(names)} don't share their dimensions")
    return list(of.pop())


class NetCdf(DataSource):
    @classmethod
    def name(cls) -> str:
        return "netcdf"

    def names(self) -> list[str]:
        return [n.strip() for n in self.options["variables"].split(",")]

    def schema(self) -> str:
        file = File(self.options["path"])
        names = [*dims_of(file, self.names()), *self.names()]
        kinds = [spark_type(file.values(n, 0, 0).dtype) if n in file.variables else "long" for n in names]
        return ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))

    def reader(self, schema) -> DataSourceReader:
        return NetCdfReader(self.options["path"], self.names(), int(self.options.get("parts", "8")))


class NetCdfReader(DataSourceReader):
    def __init__(self, path: str, names: list[str], parts: int):
        self.path, self.names, self.parts = path, names, parts

    def partitions(self) -> Sequence[InputPartition]:
        return [InputPartition(x) for x in ranges(File(self.path).variables[self.names[0]].shape[0], self.parts)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        file = File(self.path)
        first, last = partition.value
        inner = max(1, int(np.prod(file.variables[self.names[0]].shape[1:], dtype=int)))
        step = max(1, 200_000 // inner)
        for a in range(first, last, step):
            yield batch(rows(file, self.names, a, min(a + step, last)), [*dims_of(file, self.names), *self.names])


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(NetCdf)


# ---- writing


def _padded(data: bytes) -> bytes:
    return data + b"\x00" * (-len(data) % 4)


def _text(s: str) -> bytes:
    return struct.pack(">i", len(s.encode())) + _padded(s.encode())


def _attribute_list(attributes: Mapping[str, str | float]) -> bytes:
    out = struct.pack(">ii", ATTRIBUTES if attributes else 0, len(attributes))
    for k, v in attributes.items():
        out += _text(k) + (struct.pack(">i", 2) + _text(v) if isinstance(v, str) else struct.pack(">iif", 5, 1, v))
    return out


def write_cube(cube: DataFrame, path: str, units: Mapping[str, str], unit: str = "divide_id", ts: str = "ts", attributes: Mapping[str, str] | None = None) -> None:
    """One cube (unit, ts and the variables that ``units`` names) as a CF file: variables (catchment, time), ids as text, time in
    minutes since 1970, absent values as fill values. Ids and times must fit the driver; values pass through it one unit at a time."""
    ids = sorted(r[0] for r in cube.select(unit).distinct().collect())
    times = sorted(r[0] for r in cube.select(F.unix_micros(ts)).distinct().collect())
    width, names = max([1, *(len(i.encode()) for i in ids)]), list(units)
    fill = -9999.0
    fixed = [
        ("catchment_id", [0, 2], {"cf_role": "timeseries_id", "long_name": "catchment identifier"}, 2, len(ids) * width),
        ("time", [1], {"units": "minutes since 1970-01-01 00:00:00", "calendar": "standard", "standard_name": "time"}, 6, len(times) * 8),
        *((n, [0, 1], {"units": units[n], "_FillValue": fill, "coordinates": "catchment_id"}, 5, len(ids) * len(times) * 4) for n in names),
    ]
    every = {"Conventions": "CF-1.8", "featureType": "timeSeries", **(attributes or {})}

    def header(begins: Sequence[int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">i", 0) + struct.pack(">ii", DIMENSIONS, 3)
        out += b"".join(_text(n) + struct.pack(">i", k) for n, k in (("catchment", max(1, len(ids))), ("time", max(1, len(times))), ("id_length", width)))
        out += _attribute_list(every) + struct.pack(">ii", VARIABLES, len(fixed))
        for (name, dims, own, kind, size), begin in zip(fixed, begins, strict=True):
            out += _text(name) + struct.pack(f">i{len(dims)}i", len(dims), *dims) + _attribute_list(own) + struct.pack(">iiq", kind, min(-(-size // 4) * 4, 2**31 - 4), begin)
        return out

    start, begins = len(header([0] * len(fixed))), []
    for *_, size in fixed:
        begins.append(start)
        start += -(-size // 4) * 4
    at = {t: k for k, t in enumerate(times)}
    entries = F.collect_list(F.struct(F.unix_micros(ts).alias("t"), *names)).alias("entries")
    with whole(path) as name, open(name, "wb") as f:
        f.write(header(begins))
        f.truncate(start)
        f.seek(begins[0])
        f.write(b"".join(i.encode().ljust(width, b"\x00") for i in ids))
        f.seek(begins[1])
        f.write(np.array([t / 6e7 for t in times], ">f8").tobytes())
        for k, row in enumerate(cube.groupBy(unit).agg(entries).orderBy(unit).toLocalIterator()):
            for j, n in enumerate(names):
                line = np.full(len(times), fill, ">f4")
                for e in row["entries"]:
                    if e[n] is not None:
                        line[at[e["t"]]] = e[n]
                f.seek(begins[2 + j] + k * len(times) * 4)
                f.write(line.tobytes())
