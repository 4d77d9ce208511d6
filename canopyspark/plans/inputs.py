"""The tables of a folder, and the image relations that the queries are driven from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyspark.operators import pixels as px

#: Side of the rasters in the embeddings table.
SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_key, x, y, v: each embedding as a raster in row order."""
    cells = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_key"), F.posexplode("embedding").alias("i", "v"))
    return cells.select("image_key", (F.col("i") % SIDE).cast("long").alias("x"), F.floor(F.col("i") / SIDE).cast("long").alias("y"), F.col("v").cast("double").alias("v"))


RASTERS = f"""px AS (
    SELECT vec_id AS image_key, CAST(i % {SIDE} AS BIGINT) AS x, CAST(i // {SIDE} AS BIGINT) AS y, CAST(v AS DOUBLE) AS v
    FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(0, {SIDE * SIDE})) AS i FROM embeddings))"""


def masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rasters with mask: above the image's median."""
    from pyspark.sql import Window

    middle = F.median("v").over(Window.partitionBy("image_key"))
    return rasters(spark, sf_dir).withColumn("mask", F.col("v") > middle)


MASKED = RASTERS + ", mk AS (SELECT *, v > median(v) OVER (PARTITION BY image_key) AS mask FROM px)"


def coloured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rasters with bytes r, g, b made from the cell's value and place."""
    norm = px.min_max_normalised(rasters(spark, sf_dir), "v", "d")
    channel = lambda shift: F.floor(F.col("d") * 200 + (F.col("x") * shift + F.col("y") * 3) % 56).cast("int")
    return norm.withColumn("r", channel(5)).withColumn("g", channel(11)).withColumn("b", channel(17)).drop("d")


NORMALISED = RASTERS + """, nm AS (
    SELECT *, (v - min(v) OVER (PARTITION BY image_key)) / greatest(max(v) OVER (PARTITION BY image_key) - min(v) OVER (PARTITION BY image_key), 1e-6) AS d FROM px)"""
COLOURED = NORMALISED + """, cl AS (
    SELECT image_key, x, y, v, CAST(floor(d * 200 + (x * 5 + y * 3) % 56) AS BIGINT) AS r, CAST(floor(d * 200 + (x * 11 + y * 3) % 56) AS BIGINT) AS g,
        CAST(floor(d * 200 + (x * 17 + y * 3) % 56) AS BIGINT) AS b FROM nm)"""


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Columns to so many places, without a negative zero."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in columns})


#: Side of the mosaics.
WIDE = 256


def mosaics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_key, x, y, v: the embeddings' values one behind the other in rows of 256, as rasters of 256 x 256; the last one is completed
    with the table from its beginning. They grow with the table."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    size, cells = SIDE * SIDE, WIDE * WIDE
    ends = emb.agg(F.coalesce(F.max("vec_id") + 1, F.lit(0)).alias("n"))
    sized = emb.join(F.broadcast(ends), F.col("vec_id") < F.col("n"))
    total = F.ceil(F.col("n") * size / cells) * cells
    spread = sized.select(F.posexplode("embedding").alias("i", "v"), "vec_id", "n", total.alias("total"))
    first = F.col("vec_id") * size + F.col("i")
    placed = spread.where(first < F.col("total")).select("v", F.explode(F.sequence(first, F.col("total") - 1, F.col("n") * size)).alias("q"))
    at = F.col("q") % cells
    return placed.select(F.floor(F.col("q") / cells).alias("image_key"), (at % WIDE).alias("x"), F.floor(at / WIDE).alias("y"), F.col("v").cast("double").alias("v"))


MOSAICS = f"""ends AS (SELECT max(vec_id) + 1 AS n, CAST(ceil((max(vec_id) + 1) * {SIDE * SIDE} / {WIDE * WIDE}) * {WIDE * WIDE} AS BIGINT) AS total FROM embeddings),
cells AS (SELECT vec_id * {SIDE * SIDE} + i AS q, v FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(0, {SIDE * SIDE})) AS i FROM embeddings)),
spread AS (SELECT unnest(range(q, total, n * {SIDE * SIDE})) AS q, v FROM cells, ends),
mo AS (SELECT q // {WIDE * WIDE} AS image_key, q % {WIDE} AS x, q % {WIDE * WIDE} // {WIDE} AS y, CAST(v AS DOUBLE) AS v FROM spread)"""


def coloured_mosaics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mosaics with bytes r, g, b made from the cell's value and place, smooth in place."""
    norm = px.min_max_normalised(mosaics(spark, sf_dir), "v", "d")
    channel = lambda a, b, s: (F.floor(F.col("d") * s) + (F.col("x") * a + F.col("y") * b) % 160).cast("int")
    return norm.withColumn("r", channel(1, 0, 90)).withColumn("g", channel(0, 1, 70)).withColumn("b", channel(1, 1, 50)).drop("d")


COLOURED_MOSAICS = (
    MOSAICS
    + """, mn AS (SELECT *, (v - min(v) OVER (PARTITION BY image_key)) / greatest(max(v) OVER (PARTITION BY image_key) - min(v) OVER (PARTITION BY image_key), 1e-6) AS d FROM mo),
cm AS (SELECT image_key, x, y, v, CAST(floor(d * 90) + x % 160 AS BIGINT) AS r, CAST(floor(d * 70) + y % 160 AS BIGINT) AS g, CAST(floor(d * 50) + (x + y) % 160 AS BIGINT) AS b FROM mn)"""
)
