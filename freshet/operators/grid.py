"""Regular grids: cell numbers, centres, bounding boxes, neighbours."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Rows run north to south from ``north``, columns west to east from ``west``; centres are half a step inside."""

    rows: int
    columns: int
    west: float
    north: float
    step: float

    def cell(self, row: Column, col: Column) -> Column:
        return row.cast("long") * self.columns + col

    def row(self, cell: Column) -> Column:
        return F.floor(cell / F.lit(self.columns)).cast("long")

    def column(self, cell: Column) -> Column:
        return F.pmod(cell, F.lit(self.columns)).cast("long")

    def lon(self, col: Column) -> Column:
        return (col + 0.5) * self.step + self.west

    def lat(self, row: Column) -> Column:
        return F.lit(self.north) - (row + 0.5) * self.step

    def nearest(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Row and column of the cell that holds a point; null outside the grid."""
        r, c = F.floor((F.lit(self.north) - lat) / self.step).cast("long"), F.floor((lon - self.west) / self.step).cast("long")
        inside = r.between(0, self.rows - 1) & c.between(0, self.columns - 1)
        return F.when(inside, r), F.when(inside, c)

    def cells_in(self, boxes: DataFrame, pad: int = 0) -> DataFrame:
        """Rows and columns whose centres lie in (xmin, ymin, xmax, ymax), with so many more on each side."""
        first = F.greatest(F.lit(0), F.ceil((F.lit(self.north) - F.col("ymax")) / self.step - 0.5).cast("int") - pad)
        last = F.least(F.lit(self.rows - 1), F.floor((F.lit(self.north) - F.col("ymin")) / self.step - 0.5).cast("int") + pad)
        left = F.greatest(F.lit(0), F.ceil((F.col("xmin") - self.west) / self.step - 0.5).cast("int") - pad)
        right = F.least(F.lit(self.columns - 1), F.floor((F.col("xmax") - self.west) / self.step - 0.5).cast("int") + pad)
        own = boxes.withColumns({"_r0": first, "_r1": last, "_c0": left, "_c1": right}).where("_r0 <= _r1 AND _c0 <= _c1")
        down = own.withColumn("row", F.explode(F.sequence("_r0", "_r1")))
        return down.withColumn("col", F.explode(F.sequence("_c0", "_c1"))).drop("_r0", "_r1", "_c0", "_c1")

    def from_south(self, row: Column) -> Column:
        """The row from the north of one that is counted from the south."""
        return F.lit(self.rows - 1) - row

    def remapped(self, index: DataFrame) -> DataFrame:
        """Adds ``local_id``: each cell's number in the smallest box that holds all cells of the index, by rows."""
        own = index.withColumns({"_row": self.row(F.col("cell_id")), "_col": self.column(F.col("cell_id"))})
        box = own.agg(F.min("_row").alias("_r0"), F.min("_col").alias("_c0"), F.max("_col").alias("_c1"))  # one row
        return own.crossJoin(F.broadcast(box)).withColumn("local_id", (F.col("_row") - F.col("_r0")) * (F.col("_c1") - F.col("_c0") + 1) + F.col("_col") - F.col("_c0")).drop("_row", "_col", "_r0", "_c0", "_c1")

    def neighbours(self, cells: DataFrame, pad: int) -> DataFrame:
        """Each cell and those up to ``pad`` rows and columns away, once."""
        steps = F.array(*(F.lit(k) for k in range(-pad, pad + 1)))
        near = cells.withColumn("_dr", F.explode(steps)).withColumn("_dc", F.explode(steps)).select(*(c for c in cells.columns if c not in ("row", "col")), (F.col("row") + F.col("_dr")).alias("row"), (F.col("col") + F.col("_dc")).alias("col"))
        return near.where(F.col("row").between(0, self.rows - 1) & F.col("col").between(0, self.columns - 1)).distinct()

    def boxes(self, cells: DataFrame) -> DataFrame:
        half = self.step / 2
        lon, lat = self.lon(F.col("col")), self.lat(F.col("row"))
        return cells.withColumns({"xmin": lon - half, "xmax": lon + half, "ymin": lat - half, "ymax": lat + half})

    def touched(self, boxes: DataFrame) -> DataFrame:
        """Rows and columns of all cells that boxes (xmin, ymin, xmax, ymax) touch, once; they go on beyond the grid's edges, where numbers are negative or large."""
        n = lambda c: F.floor(c / self.step).cast("long")
        down = boxes.select("xmin", "xmax", F.explode(F.sequence(n(F.lit(self.north) - F.col("ymax")), n(F.lit(self.north) - F.col("ymin")))).alias("row"))
        return down.select("row", F.explode(F.sequence(n(F.col("xmin") - self.west), n(F.col("xmax") - self.west))).alias("col")).distinct()

    def table(self, spark: SparkSession) -> DataFrame:
        """All cells with their centres."""
        cells = spark.range(self.rows * self.columns).withColumnRenamed("id", "cell_id")
        own = cells.withColumns({"row": self.row(F.col("cell_id")), "col": self.column(F.col("cell_id"))})
        return own.withColumns({"lon": self.lon(F.col("col")), "lat": self.lat(F.col("row"))})


#: The 0.01 degree radar grid and the hourly forcing grid's size.
RADAR = Grid(3500, 7000, -130.0, 55.0, 0.01)
FORCING_ROWS, FORCING_COLUMNS = 4201, 8401


def bounds(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(*(f(c).alias(f"{c}_{n}") for c in ("row", "col") for n, f in (("min", F.min), ("max", F.max))))


def box_fraction(a: str = "", b: str = "b_") -> Column:
    """Share of box ``a`` (columns xmin.. with a prefix) that lies in box ``b``."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(F.col(f"{a}{hi}"), F.col(f"{b}{hi}")) - F.greatest(F.col(f"{a}{lo}"), F.col(f"{b}{lo}")))
    area = (F.col(f"{a}xmax") - F.col(f"{a}xmin")) * (F.col(f"{a}ymax") - F.col(f"{a}ymin"))
    return F.least(F.greatest(F.try_divide(side("xmin", "xmax") * side("ymin", "ymax"), area), F.lit(0.0)), F.lit(1.0))


def overlap_kind(fraction: Column, whole: float = 0.999) -> Column:
    return F.when(fraction >= whole, "whole").otherwise("fractional")
