"""Image rows to pixel rows (SRC-10).

Works on the row layout of Spark's ``image`` data source: a struct with
``origin``, ``height``, ``width``, ``nChannels``, ``mode`` and ``data``
(bytes row after row, channels in B, G, R(, A) order).  Every image becomes
``height * width`` rows ``(origin, pixel, y, x, r, g, b)``, pixel index row
after row as a ``reshape(h * w, 3)`` gives it.  The work per image is
bounded by its own size; images spread over tasks like any other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IMAGE_SCHEMA = ("struct<origin:string,height:int,width:int,nChannels:int,"
                "mode:int,data:binary>")


def _byte(hexdata: Column, offset: Column) -> Column:
    """Unsigned byte at 0-based ``offset`` of a hex-encoded buffer."""
    return F.conv(F.substring(hexdata, offset * 2 + 1, 2), 16, 10).cast("int")


def read_images(spark, path: str) -> DataFrame:
    """Image files through Spark's image source (one row per file)."""
    return spark.read.format("image").option("dropInvalid", True).load(path)


def pixel_rows(images: DataFrame, image_col: str = "image") -> DataFrame:
    im = F.col(image_col)
    base = images.select(
        im["origin"].alias("origin"), im["height"].alias("h"), im["width"].alias("w"),
        im["nChannels"].alias("c"), F.hex(im["data"]).alias("_hex"))
    px = base.select("origin", "w", "c", "_hex",
                     F.explode(F.sequence(F.lit(0), F.col("h") * F.col("w") - 1)).alias("pixel"))
    off = F.col("pixel") * F.col("c")
    one = F.col("c") == 1
    b = _byte(F.col("_hex"), off)
    g = F.when(one, b).otherwise(_byte(F.col("_hex"), off + 1))
    r = F.when(one, b).otherwise(_byte(F.col("_hex"), off + 2))
    return px.select(
        "origin", "pixel",
        (F.col("pixel") / F.col("w")).cast("int").alias("y"),
        (F.col("pixel") % F.col("w")).cast("int").alias("x"),
        r.cast("short").alias("r"), g.cast("short").alias("g"), b.cast("short").alias("b"))


def image_from_channels(origin: Column, height: int, width: int,
                        red: Column, green: Column, blue: Column) -> Column:
    """Build an image-source struct from three arrays of 0..255 ints (one
    value per pixel, row after row); bytes are written B, G, R."""
    def hx(c):
        return F.lpad(F.hex(c), 2, "0")
    trip = F.arrays_zip(red.alias("r"), green.alias("g"), blue.alias("b"))
    hexdata = F.array_join(F.transform(trip, lambda t: F.concat(hx(t["b"]), hx(t["g"]), hx(t["r"]))), "")
    return F.struct(origin.alias("origin"), F.lit(height).alias("height"), F.lit(width).alias("width"),
                    F.lit(3).alias("nChannels"), F.lit(16).alias("mode"),
                    F.unhex(hexdata).alias("data"))
