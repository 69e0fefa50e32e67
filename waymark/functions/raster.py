"""Numbers on grids: elevation from colours, masks and statistics inside a circle, as expressions on arrays in row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def terrarium_metres(red: Column, green: Column, blue: Column) -> Column:
    """Metres above the sea from the colour of an elevation tile's pixel."""
    # The published encoding.
    return red * 256.0 + green + blue / 256.0 - 32768.0


def in_circle(cells: Column, width: int, row: float, column: float, radius: float) -> Column:
    """The values of an array of rows of ``width`` cells that lie within ``radius`` cells of a centre; the edge counts as inside."""
    at = F.transform(cells, lambda v, i: F.struct(v.alias("v"), F.floor(i / width).cast("double").alias("r"), (i % width).cast("double").alias("c")))
    held = F.filter(at, lambda x: (x["r"] - row) * (x["r"] - row) + (x["c"] - column) * (x["c"] - column) <= radius * radius)
    return F.transform(held, lambda x: x["v"])


def relief(cells: Column, width: int, row: float, column: float, wide: float, narrow: float) -> Column:
    """``(relief, top, centre)``: highest minus lowest within the wide circle, highest within the narrow one, and the centre's value."""
    big, small = in_circle(cells, width, row, column, wide), in_circle(cells, width, row, column, narrow)
    return F.struct((F.array_max(big) - F.array_min(big)).alias("relief"), F.array_max(small).alias("top"), F.get(cells, F.lit(round(row) * width + round(column))).alias("centre"))


def class_shares(cells: Column, width: int, radius: float, classes: dict[str, int]) -> Column:
    """Share of each class among the known cells (above 0) of the circle round the grid's middle; null where none is known."""
    height = F.floor(F.size(cells) / width).cast("double")
    at = F.transform(cells, lambda v, i: F.struct(v.alias("v"), (F.floor(i / width) - (height - 1) / 2).alias("r"), (i % width - (width - 1) / 2).alias("c")))
    known = F.filter(at, lambda x: (x["r"] * x["r"] + x["c"] * x["c"] <= radius * radius) & (x["v"] > 0))
    n = F.nullif(F.size(known), F.lit(0))

    def share(code: int) -> Column:
        return F.round(F.size(F.filter(known, lambda x: x["v"] == code)) / n, 4)

    return F.struct(*[share(code).alias(name) for name, code in classes.items()])
