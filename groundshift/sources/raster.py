"""Rasters as pixel tables and as tables of square array tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from groundshift import config as c
from groundshift.operators.raster import extent
from groundshift.operators.small import settle

TILE = [*c.RASTER, "tile_row", "tile_col"]


def pixels_to_tiles(px: DataFrame, bands: list[str], tile: int = 256, nodata=c.NODATA) -> DataFrame:
    """Full-extent tiles of row-major band arrays; absent and missing pixels hold ``nodata``.

    A pixel given twice stops the job. Edge tiles are cut to the raster (``tile_h`` x ``tile_w``). One seed row per
    tile makes tiles without a pixel appear, so a single shuffle on the tile key
    does everything.
    """
    kinds = {b: px.schema[b].dataType for b in bands}
    size = settle(extent(px))
    sized = px.join(size, c.RASTER)

    def last(n: str) -> Column:
        return F.floor((F.col(n) - 1) / tile).cast("int")

    t_row, t_col = F.floor(F.col("px_row") / tile).cast("int"), F.floor(F.col("px_col") / tile).cast("int")
    tile_w = F.least(F.lit(tile), F.col("width") - t_col * tile)
    pos = (F.col("px_row") - t_row * tile) * tile_w + (F.col("px_col") - t_col * tile)
    pixels = sized.select(
        *c.RASTER,
        t_row.alias("tile_row"),
        t_col.alias("tile_col"),
        F.struct(pos.cast("int").alias("pos"), *[F.coalesce(b, F.lit(nodata).cast(kinds[b])).alias(b) for b in bands]).alias("cell"),
        F.lit(None).cast("int").alias("h"),
        F.lit(None).cast("int").alias("w"),
    )
    seeds = (
        size.withColumn("tile_row", F.explode(F.sequence(F.lit(0), last("height"))))
        .withColumn("tile_col", F.explode(F.sequence(F.lit(0), last("width"))))
        .select(
            *TILE,
            F.lit(None).cast(pixels.schema["cell"].dataType).alias("cell"),
            F.least(F.lit(tile), F.col("height") - F.col("tile_row") * tile).cast("int").alias("h"),
            F.least(F.lit(tile), F.col("width") - F.col("tile_col") * tile).cast("int").alias("w"),
        )
    )
    packed = pixels.unionByName(seeds).groupBy(*TILE).agg(
        F.collect_list("cell").alias("cells"), F.max("h").alias("tile_h"), F.max("w").alias("tile_w")
    )
    holes = F.array_except(F.sequence(F.lit(0), F.col("tile_h") * F.col("tile_w") - 1), F.col("cells.pos"))
    filler = F.transform(
        holes, lambda p: F.struct(p.alias("pos"), *[F.lit(nodata).cast(kinds[b]).alias(b) for b in bands])
    )
    twice = F.size(F.array_distinct("cells.pos")) < F.size("cells.pos")
    place = F.concat_ws(" ", F.lit("a pixel is given twice in tile"), *[F.col(n).cast("string") for n in TILE])
    packed = packed.withColumn("cells", F.when(twice, F.raise_error(place).cast(packed.schema["cells"].dataType)).otherwise(F.col("cells")))
    cell_type = f"array<{pixels.schema['cell'].dataType.simpleString()}>"
    full = F.sort_array(F.concat(F.col("cells").cast(cell_type), filler.cast(cell_type)))
    return packed.withColumn("cells", full).select(*TILE, "tile_h", "tile_w", *[F.col(f"cells.{b}").alias(b) for b in bands])


def tiles_to_pixels(tiles: DataFrame, bands: list[str], tile: int = 256) -> DataFrame:
    """Tiles back to one row per pixel, no-data cells included."""
    cells = tiles.select(*TILE, "tile_w", F.posexplode(F.arrays_zip(*bands)).alias("pos", "v"))
    row = F.floor(F.col("pos") / F.col("tile_w")).cast("int")
    return cells.select(
        *c.RASTER,
        (F.col("tile_row") * tile + row).alias("px_row"),
        (F.col("tile_col") * tile + F.col("pos") - row * F.col("tile_w")).alias("px_col"),
        *[F.col(f"v.{b}").alias(b) for b in bands],
    )


def write_raster(px: DataFrame, path: str, block: int = 256) -> None:
    """Pixel rows as Parquet, one folder per city and epoch.

    Blocks of lines spread a large raster over many tasks; the sort leaves every
    row group with a narrow band of lines.
    """
    lines = F.floor(F.col("px_row") / block)
    px.repartition(*c.RASTER, lines).sortWithinPartitions(*c.PIXEL).write.partitionBy(*c.RASTER).mode("overwrite").parquet(path)


def write_raster_table(px: DataFrame, name: str, buckets: int = c.RASTER_BUCKETS) -> None:
    """Pixel rows as a table bucketed by pixel: joins of two such tables by pixel
    key need no shuffle. The rows are dealt as the buckets are, one file for each."""
    dealt = px.repartition(buckets, *c.PIXEL)
    dealt.write.bucketBy(buckets, *c.PIXEL).sortBy(*c.PIXEL).mode("overwrite").saveAsTable(name)


def read_raster(spark: SparkSession, path: str) -> DataFrame:
    px = spark.read.parquet(path)
    rest = [n for n in px.columns if n not in c.PIXEL]
    return px.select(*c.PIXEL, *rest)


def is_table(where: str) -> bool:
    """A name without a slash or scheme is a table of the catalog, anything else a folder."""
    return "/" not in where and ":" not in where


def save_raster(px: DataFrame, where: str) -> None:
    write_raster_table(px, where) if is_table(where) else write_raster(px, where)


def open_raster(spark: SparkSession, where: str) -> DataFrame:
    if not is_table(where):
        return read_raster(spark, where)
    px = spark.table(where)
    return px.select(*c.PIXEL, *[n for n in px.columns if n not in c.PIXEL])
