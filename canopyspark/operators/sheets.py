"""Sheets of labelled panels. Letters are a relation of lit cells, joined to a sheet's pixels by panel and place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyspark.operators import pixels as px

# Letters, digits and a dash as rows of three cells, from the top.
GLYPHS = {
    "A": "010 101 111 101 101", "B": "110 101 110 101 110", "C": "011 100 100 100 011", "D": "110 101 101 101 110", "E": "111 100 110 100 111",
    "F": "111 100 110 100 100", "G": "011 100 101 101 011", "H": "101 101 111 101 101", "I": "111 010 010 010 111", "J": "001 001 001 101 010",
    "K": "101 101 110 101 101", "L": "100 100 100 100 111", "M": "101 111 111 101 101", "N": "110 101 101 101 101", "O": "010 101 101 101 010",
    "P": "110 101 110 100 100", "Q": "010 101 101 110 011", "R": "110 101 110 101 101", "S": "011 100 010 001 110", "T": "111 010 010 010 010",
    "U": "101 101 101 101 111", "V": "101 101 101 101 010", "W": "101 101 111 111 101", "X": "101 101 010 101 101", "Y": "101 101 010 010 010",
    "Z": "111 001 010 100 111", "0": "111 101 101 101 111", "1": "010 110 010 010 111", "2": "111 001 111 100 111", "3": "111 001 111 001 111",
    "4": "101 101 111 001 001", "5": "111 100 111 001 111", "6": "111 100 111 101 111", "7": "111 001 001 001 001", "8": "111 101 111 101 111",
    "9": "111 101 111 001 111", "-": "000 000 111 000 000",
}
#: Cells that a letter takes with the gap behind it, and rows of the band that a label stands in.
PITCH, BAND = 4, 7


def lit_cells() -> list[tuple[str, int, int]]:
    return [(letter, gx, gy) for letter, rows in GLYPHS.items() for gy, row in enumerate(rows.split()) for gx, cell in enumerate(row) if cell == "1"]


def glyphs(spark: SparkSession) -> DataFrame:
    """letter, gx, gy of the lit cells."""
    return spark.createDataFrame(lit_cells(), "letter string, gx long, gy long")


def lettered(labels: DataFrame, scale: int = 3) -> DataFrame:
    """panel, x, y: the lit pixels of each panel's label, from its upper left corner. Small letters are shown as large ones; what has no
    glyph leaves a gap."""
    letters = labels.select("panel", F.posexplode(F.split(F.upper("label"), "")).alias("place", "letter"))
    cells = letters.join(F.broadcast(glyphs(labels.sparkSession)), "letter")  # a fixed table of some 350 rows
    within = F.explode(F.sequence(F.lit(0), F.lit(scale - 1)))
    wide = cells.select("panel", "place", "gx", "gy", within.alias("sx")).select("*", within.alias("sy"))
    return wide.select("panel", ((F.col("place") * PITCH + 1 + F.col("gx")) * scale + F.col("sx")).alias("x"), ((1 + F.col("gy")) * scale + F.col("sy")).alias("y"))


def labelled_sheet(panels: DataFrame, labels: DataFrame, side: int = 320, columns: int = 5, scale: int = 3) -> DataFrame:
    """image_key, panel, x, y, r, g, b: one sheet for each image, of its panels (image_key, panel, x, y, r, g, b, w, h) as square tiles of
    a side, row by row. The upper rows of a tile are darkened to a quarter, and the panel's label (panel, label) stands there in white, cut
    at the tile's edge."""
    sheet = px.contact_sheet(panels.select("image_key", "panel", "x", "y", "r", "g", "b", "w", "h"), side, columns)
    dots = lettered(labels, scale).where((F.col("x") < side) & (F.col("y") < side))
    placed = dots.select("panel", (F.col("panel") % columns * side + F.col("x")).alias("x"), (F.floor(F.col("panel") / columns) * side + F.col("y")).alias("y"), F.lit(True).alias("__lit"))
    both = sheet.join(placed, ["panel", "x", "y"], "left")
    band = F.col("y") % side < BAND * scale
    shown = {c: F.when(F.col("__lit"), 255).when(band, F.floor(F.col(c) / 4).cast("int")).otherwise(F.col(c)) for c in "rgb"}
    return both.withColumns(shown).select("image_key", "panel", "x", "y", "r", "g", "b")
