"""Zarr stores (version 2) as a Python data source: ``spark.read.format("zarr").option("variables", "a,b").load(store)``.

One row for each place in the grid of the named arrays, which share dimensions and chunks: a column a dimension (the value of the array of
that name, else the number from 0), then the arrays. A task reads a range of chunks; chunks that aren't stored hold the fill value,
which is null. Compressors: none, zlib, gzip, bz2, lzma, zstd; others raise ValueError. The store must be readable at the same path by driver and executors.
"""

from __future__ import annotations

import bz2
import gzip
import itertools
import json
import lzma
import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from freshet.session import ship
from freshet.sources.files import batch, local, ranges, spark_type


def _unpacked(data: bytes, compressor: dict | None) -> bytes:
    kind = (compressor or {}).get("id")
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    plain = {None: lambda x: x, "zlib": zlib.decompress, "gzip": gzip.decompress, "bz2": bz2.decompress, "lzma": lzma.decompress}
    if kind not in plain:
        raise ValueError(f"compressor {kind} is not at hand")
    return plain[kind](data)


class Array:
    def __init__(self, store: str, name: str):
        self.at, self.name = os.path.join(local(store), name), name
        with open(f"{self.at}/.zarray") as f:
            self.meta = json.load(f)
        if self.meta["zarr_format"] != 2 or self.meta.get("filters"):
            raise ValueError(f"{name} is no plain array of version 2")
        attributes = {}
        if os.path.exists(f"{self.at}/.zattrs"):
            with open(f"{self.at}/.zattrs") as f:
                attributes = json.load(f)
        self.shape, self.chunks, self.dtype = self.meta["shape"], self.meta["chunks"], np.dtype(self.meta["dtype"])
        self.dims = attributes.get("_ARRAY_DIMENSIONS", [f"dim_{k}" for k in range(len(self.shape))])
        self.fill = self.meta["fill_value"]
        self.scale, self.offset, self.missing = attributes.get("scale_factor", 1), attributes.get("add_offset", 0), attributes.get("_FillValue", self.fill)

    def chunk(self, number: Sequence[int]) -> np.ndarray:
        """A chunk's values, cut at the array's end: real numbers, whole numbers without a fill value, or text."""
        path = f"{self.at}/{self.meta.get('dimension_separator', '.').join(map(str, number))}"
        if os.path.exists(path):
            with open(path, "rb") as f:
                got = np.frombuffer(_unpacked(f.read(), self.meta["compressor"]), self.dtype).reshape(self.chunks, order=self.meta["order"])
        else:
            got = np.full(self.chunks, self.fill if self.fill is not None else 0, self.dtype)
        got = got[tuple(slice(0, n - k * c) for n, k, c in zip(self.shape, number, self.chunks, strict=True))]
        if self.dtype.kind in "iu" and self.missing is None and (self.scale, self.offset) == (1, 0):
            return got.astype("i8")
        if self.dtype.kind in "iuf":
            real = got.astype("f8")
            if self.missing is not None and self.missing != "NaN":
                real[got == self.missing] = np.nan
            return real * self.scale + self.offset
        return got.astype("U")

    def numbers(self) -> list[tuple[int, ...]]:
        return list(itertools.product(*(range(-(-n // c)) for n, c in zip(self.shape, self.chunks, strict=True))))

    def whole(self) -> np.ndarray:
        """All values of a short array (a coordinate)."""
        return np.concatenate([self.chunk(k) for k in self.numbers()])


class Zarr(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zarr"

    def names(self) -> list[str]:
        return [n.strip() for n in self.options["variables"].split(",")]

    def schema(self) -> str:
        store = self.options["path"]
        arrays = [Array(store, n) for n in self.names()]
        if any((a.dims, a.shape, a.chunks) != (arrays[0].dims, arrays[0].shape, arrays[0].chunks) for a in arrays):
            raise ValueError(f"{self.names()} don't share dimensions and chunks")
        kinds = [spark_type(Array(store, d).chunk([0]).dtype) if os.path.exists(f"{local(store)}/{d}/.zarray") else "long" for d in arrays[0].dims]
        return ", ".join(f"`{n}` {k}" for n, k in zip([*arrays[0].dims, *self.names()], [*kinds, *(spark_type(a.chunk([0] * len(a.shape)).dtype) for a in arrays)], strict=True))

    def reader(self, schema) -> DataSourceReader:
        return ZarrReader(self.options["path"], self.names(), int(self.options.get("parts", "8")))


class ZarrReader(DataSourceReader):
    def __init__(self, store: str, names: list[str], parts: int):
        self.store, self.names, self.parts = store, names, parts

    def partitions(self) -> Sequence[InputPartition]:
        return [InputPartition(x) for x in ranges(len(Array(self.store, self.names[0]).numbers()), self.parts)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        arrays = [Array(self.store, n) for n in self.names]
        lead = arrays[0]
        axes = [Array(self.store, d).whole() if os.path.exists(f"{local(self.store)}/{d}/.zarray") else np.arange(n) for d, n in zip(lead.dims, lead.shape, strict=True)]
        for number in lead.numbers()[slice(*partition.value)]:
            values = [a.chunk(number) for a in arrays]
            grid = np.indices(values[0].shape)
            columns = [axis[g.ravel() + k * c] for axis, g, k, c in zip(axes, grid, number, lead.chunks, strict=True)]
            yield batch([*columns, *(v.ravel() for v in values)], [*lead.dims, *self.names])


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(Zarr)


def years(spark: SparkSession, base: str, first: int, last: int, variables: Sequence[str]) -> DataFrame:
    """The stores ``base/YYYY.zarr`` of a span of years as one table with a year; other years are not opened."""
    register(spark)
    found = [spark.read.format("zarr").option("variables", ",".join(variables)).load(f"{base}/{y}.zarr").withColumn("year", F.lit(y)) for y in range(first, last + 1) if os.path.exists(f"{local(base)}/{y}.zarr")]
    if not found:
        raise ValueError(f"no store of {first} to {last} in {base}")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def write_array(store: str, name: str, values: np.ndarray, dims: Sequence[str], chunks: Sequence[int], compressor: str | None = "zlib") -> None:
    """One array, chunk by chunk."""
    at = os.path.join(local(store), name)
    os.makedirs(at, exist_ok=True)
    with open(f"{local(store)}/.zgroup", "w") as f:
        json.dump({"zarr_format": 2}, f)
    fill = "NaN" if values.dtype.kind == "f" else None
    for file, body in ((".zarray", {"zarr_format": 2, "shape": list(values.shape), "chunks": list(chunks), "dtype": values.dtype.str, "compressor": {"id": "zlib", "level": 1} if compressor else None, "fill_value": fill, "order": "C", "filters": None}), (".zattrs", {"_ARRAY_DIMENSIONS": list(dims)})):
        with open(f"{at}/{file}", "w") as f:
            json.dump(body, f)
    for number in itertools.product(*(range(-(-n // c)) for n, c in zip(values.shape, chunks, strict=True))):
        part = np.full(chunks, np.nan if fill else 0, values.dtype)
        own = values[tuple(slice(k * c, (k + 1) * c) for k, c in zip(number, chunks, strict=True))]
        part[tuple(slice(0, n) for n in own.shape)] = own
        with open(f"{at}/{'.'.join(map(str, number))}", "wb") as f:
            f.write(zlib.compress(part.tobytes(), 1) if compressor else part.tobytes())
