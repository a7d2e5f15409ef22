"""GeoPackage (SQLite) layers as a Python data source: ``spark.read.format("gpkg").option("layer", ...).load(path)``.

The file must be readable at the same path by driver and executors. Columns come from the layer's table or the
``columns`` option; geometries become well-known binary, or are left out with ``geometry=false``. Equality and IN filters are
pushed into the layer's SQL. Rows are read by ranges of the row id. With the option ``query`` instead of ``layer``, and a schema, the rows of any SQL over the
file's tables are read, in one task. ``write_layer`` writes a table as a layer.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator, Sequence
from contextlib import closing

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from freshet.functions.wkb import gpkg_geometry
from freshet.session import ship
from freshet.sources.files import local

KINDS = {"INTEGER": "long", "MEDIUMINT": "long", "INT": "long", "BIGINT": "long", "SMALLINT": "long", "BOOLEAN": "long", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BLOB": "binary"}
GEOMETRIES = ("GEOMETRY", "POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON", "GEOMETRYCOLLECTION")


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def layers(path: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """Names of tables with their columns and declared types; no row is read."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        names = [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'gpkg_%' AND name NOT LIKE 'sqlite_%' AND name NOT LIKE 'rtree_%' ORDER BY 1")]
        return [(n, [(r[1], r[2]) for r in db.execute(f"PRAGMA table_info({quoted(n)})")]) for n in names]


class GeoPackage(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def columns(self) -> list[tuple[str, str, bool]]:
        """name, Spark type, is geometry."""
        all_ = dict(layers(self.options["path"]))[self.options["layer"]]
        wanted = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        geometry = self.options.get("geometry", "true").lower() == "true"
        out = [(n, "binary" if (g := t.upper() in GEOMETRIES) else KINDS.get(t.upper().split("(")[0], "string"), g) for n, t in all_ if not wanted or n in wanted]
        return [c for c in out if geometry or not c[2]]

    def schema(self) -> str:
        return ", ".join(f"`{n}` {k}" for n, k, _ in self.columns())

    def reader(self, schema) -> DataSourceReader:
        if "query" in self.options:
            return QueryReader(self.options["path"], self.options["query"])
        return LayerReader(self.options["path"], self.options["layer"], self.columns(), int(self.options.get("parts", "4")))


class LayerReader(DataSourceReader):
    def __init__(self, path: str, layer: str, columns: list[tuple[str, str, bool]], parts: int):
        self.path, self.layer, self.columns, self.parts = path, layer, columns, parts
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1:
                self.where.append(f"{quoted(f.attribute[0])} = ?")
                self.values.append(f.value)
            elif isinstance(f, In) and len(f.attribute) == 1 and len(f.value) < 900:
                self.where.append(f"{quoted(f.attribute[0])} IN ({', '.join('?' * len(f.value))})")
                self.values += list(f.value)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.layer)}").fetchone()
        if low is None:
            return [InputPartition((0, 0))]
        step = -(-(high - low + 1) // self.parts)
        return [InputPartition((a, min(a + step, high + 1))) for a in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        a, b = partition.value
        names = ", ".join(quoted(n) for n, _, _ in self.columns)
        where = " AND ".join(["rowid >= ? AND rowid < ?", *self.where])
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for row in db.execute(f"SELECT {names} FROM {quoted(self.layer)} WHERE {where}", [a, b, *self.values]):
                yield tuple(gpkg_geometry(v) if g and v is not None else v for v, (_, _, g) in zip(row, self.columns, strict=True))


class QueryReader(DataSourceReader):
    def __init__(self, path: str, sql: str):
        self.path, self.sql = path, sql

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            yield from db.execute(self.sql)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GeoPackage)


def queried(spark: SparkSession, path: str, sql: str, schema: str) -> DataFrame:
    """The rows of a SQL query over a file's tables."""
    register(spark)
    return spark.read.format("gpkg").schema(schema).option("query", sql).load(local(path))


def write_layer(df: DataFrame, path: str, layer: str, geometry: str | None = None, kind: str = "POLYGON", srs: int = 5070) -> None:
    """A table as the layer of a GeoPackage, which is made if it isn't there; a layer of that name is replaced. A GeoPackage is one
    file with one writer: rows pass through the driver one partition at a time."""
    names = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "boolean": "BOOLEAN", "double": "REAL", "float": "REAL", "binary": "BLOB"}
    columns = [(f.name, kind if f.name == geometry else names.get(f.dataType.simpleString(), "TEXT")) for f in df.schema]
    head = b"GP\x00\x01" + srs.to_bytes(4, "little")
    path = local(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with closing(sqlite3.connect(path)) as db, db:
        db.execute("PRAGMA application_id = 1196444487")  # fixed value of the format
        db.execute("CREATE TABLE IF NOT EXISTS gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT)")
        db.execute("CREATE TABLE IF NOT EXISTS gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, srs_id INTEGER)")
        db.execute("CREATE TABLE IF NOT EXISTS gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL)")
        db.execute("INSERT OR IGNORE INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srs}", srs, srs))
        for t in ("gpkg_contents", "gpkg_geometry_columns"):
            db.execute(f"DELETE FROM {t} WHERE table_name = ?", (layer,))
        db.execute(f"DROP TABLE IF EXISTS {quoted(layer)}")
        own = "" if any(n.lower() == "fid" for n, _ in columns) else "fid INTEGER PRIMARY KEY, "
        db.execute(f"CREATE TABLE {quoted(layer)} ({own}{', '.join(f'{quoted(n)} {k}' for n, k in columns)})")
        db.execute("INSERT INTO gpkg_contents VALUES (?, ?, ?, ?)", (layer, "features" if geometry else "attributes", layer, srs if geometry else None))
        if geometry:
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, ?, ?, 0, 0)", (layer, geometry, kind, srs))
        rows = (tuple(None if v is None else head + bytes(v) if n == geometry else bytes(v) if isinstance(v, bytearray) else v if isinstance(v, int | float | str | bytes) else str(v) for v, (n, _) in zip(r, columns, strict=True)) for r in df.toLocalIterator())
        db.executemany(f"INSERT INTO {quoted(layer)} ({', '.join(quoted(n) for n, _ in columns)}) VALUES ({', '.join('?' * len(columns))})", rows)
