"""Sky cells and their neighbours: rows of cells, padding lists, border strips, pixels in quadrangles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The sides of a cell, as the columns pad_skycell_<side> name them.
SIDES = ["top", "right", "bottom", "left", "top_right", "top_left", "bottom_right", "bottom_left"]


def projection_rows(cells: DataFrame, row: str, cell: str) -> DataFrame:
    """(row, cells): the sorted cells of each row of a projection, which has tens of them."""
    return cells.groupBy(row).agg(F.sort_array(F.collect_list(cell)).alias("cells"))


def cell_places(cells: DataFrame, projection: str, row: str, cell: str) -> DataFrame:
    """Adds row_index and cell_index, both from 0, within a projection and its row."""
    rows = Window.partitionBy(projection).orderBy(row)
    inside = Window.partitionBy(projection, row).orderBy(cell)
    return cells.withColumns({"row_index": F.dense_rank().over(rows) - 1, "cell_index": F.row_number().over(inside) - 1})


def padding(cells: DataFrame, name: str, sides: Sequence[str] = SIDES, prefix: str = "pad_skycell_") -> DataFrame:
    """(name, side, neighbour) of lists between / or , ; blanks go."""
    lists = F.array(*(F.struct(F.lit(s).alias("side"), F.col(prefix + s).alias("text")) for s in sides))
    rows = cells.select(name, F.inline(lists)).withColumn("neighbour", F.explode(F.split("text", "[/,]")))
    return rows.select(name, "side", F.trim("neighbour").alias("neighbour")).where("neighbour <> ''")


def neighbours(padded: DataFrame, name: str) -> DataFrame:
    """(name, neighbour) once each, without the cell itself."""
    return padded.where(F.col("neighbour") != F.col(name)).select(name, "neighbour").distinct()


def row_sources(cells: DataFrame, projection: str, row: str, cell: str) -> DataFrame:
    """(projection, row, cell, uses): the cells that a step over each row needs, its own and the next row's, with the steps that use each."""
    w = Window.partitionBy(projection).orderBy(row)
    rows = cells.groupBy(projection, row).agg(F.collect_set(cell).alias("own"))
    steps = rows.withColumn("next", F.lead("own").over(w))
    need = steps.select(projection, row, F.explode(F.array_union("own", F.coalesce("next", F.array().cast("array<string>")))).alias(cell))
    return need.join(need.groupBy(projection, cell).agg(F.count(F.lit(1)).alias("uses")), [projection, cell])


def border_strips(mapping: DataFrame, keys: Sequence[str], nx: int, ny: int, distance: int = 500, margin: int = 10) -> DataFrame:
    """(keys, a flag per side): does a mapped pixel (x, y, value from 0 on) lie in the strip `distance` wide inside the margin?"""
    x, y = F.col("x"), F.col("y")
    low = lambda c: (c >= margin) & (c < margin + distance)
    high = lambda c, n: (c >= n - margin - distance) & (c < n - margin)
    inner = lambda c, n: (c >= margin) & (c < n - margin)
    parts = {
        "top": high(y, ny) & inner(x, nx), "bottom": low(y) & inner(x, nx), "left": low(x) & inner(y, ny), "right": high(x, nx) & inner(y, ny),
        "top_left": high(y, ny) & low(x), "top_right": high(y, ny) & high(x, nx), "bottom_left": low(y) & low(x), "bottom_right": low(y) & high(x, nx),
    }
    mapped = F.col("value") != -1
    return mapping.groupBy(*keys).agg(*(F.coalesce(F.bool_or(mapped & inside), F.lit(False)).alias(n) for n, inside in parts.items()))


def crosses(x: Column, y: Column, corners: Column) -> Column:
    """Is the point inside the polygon of an array of struct(x, y)?  Edges count their upper end and the points on them."""
    n = F.size(corners)

    def step(inside: Column, i: Column) -> Column:
        a, b = F.get(corners, i), F.get(corners, (i + 1) % n)
        level = (y > F.least(a["y"], b["y"])) & (y <= F.greatest(a["y"], b["y"])) & (x <= F.greatest(a["x"], b["x"]))
        hit = level & ((a["x"] == b["x"]) | (x <= (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]))
        return F.when(F.coalesce(hit, F.lit(False)), ~inside).otherwise(inside)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(False), step)


def pixels_inside(shapes: DataFrame, corners: str, nx: int, ny: int) -> DataFrame:
    """Every shape's whole pixels (x, y) inside its polygon and the plane: its bounding box, tested point by point."""
    part = lambda c: F.transform(corners, lambda p: p[c])
    span = lambda c, n: (F.greatest(F.floor(F.array_min(part(c))), F.lit(0)).cast("int"), F.least(F.ceil(F.array_max(part(c))), F.lit(n - 1)).cast("int"))
    (x0, x1), (y0, y1) = span("x", nx), span("y", ny)
    boxed = shapes.where((x0 <= x1) & (y0 <= y1)).withColumn("y", F.explode(F.sequence(y0, y1))).withColumn("x", F.explode(F.sequence(x0, x1)))
    return boxed.where(crosses(F.col("x").cast("double"), F.col("y").cast("double"), F.col(corners)))
