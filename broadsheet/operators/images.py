"""Images of pages and articles: native selection, caps, insights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Least width, height and share of the page of a native image; most images of an article
# that are looked at; what a chart's description begins with.
LEAST_WIDTH, LEAST_HEIGHT, LEAST_SHARE = 45.0, 30.0, 0.0025
MOST_IMAGES = 6
CHART_MARK = "📊 图表:"


def native_images(rects: DataFrame, width: float = LEAST_WIDTH, height: float = LEAST_HEIGHT, share: float = LEAST_SHARE) -> DataFrame:
    """(page, image, xref, x0, y0, x1, y1, path): images of pages from places of image objects, numbered in listing order.

    rects: page, position (of the object in the page's list), xref, x0, y0, x1, y1, page_width, page_height. An object counts once, at its largest
    place (the first of equals); small ones go.
    """
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    rows = rects.withColumn("area", area).filter((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))
    place = F.struct(F.col("area"), -F.col("position"), F.struct("x0", "y0", "x1", "y1", "page_width", "page_height").alias("r"))
    best = rows.groupBy("page", "xref").agg(F.min("position").alias("position"), F.max(place)["r"].alias("r")).select("page", "xref", "position", "r.*")
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    kept = best.filter((w >= width) & (h >= height) & (w * h / F.greatest(F.col("page_width") * F.col("page_height"), F.lit(1.0)) >= share))
    numbered = kept.withColumn("image", F.row_number().over(Window.partitionBy("page").orderBy("position", "xref")).cast("long"))
    return numbered.select("page", "image", "xref", "x0", "y0", "x1", "y1", F.format_string("images/page_%d_fig_%d.jpg", "page", "image").alias("path"))


def capped(images: Column, most: int = MOST_IMAGES) -> Column:
    """The first images of an article, blank paths left out."""
    return F.slice(F.filter(F.coalesce(images, F.array().cast("array<string>")), lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""), 1, most)


def insights_of_reply(reply: Column, usable: Column) -> Column:
    """struct(reviewed, insights) of a model's reply on an article's images.

    Only usable paths count. An image that the reply doesn't keep has no insight; an unknown type is
    image; a chart's description begins with its mark.
    """
    kind = "array<struct<path string, image_type string, keep boolean, description string>>"
    items = F.coalesce(F.from_json(F.get_json_object(reply, "$.images"), kind), F.array().cast(kind))
    known = F.filter(items, lambda x: F.coalesce(F.array_contains(usable, F.trim(x["path"])), F.lit(False)))

    def one(x: Column) -> Column:
        named = F.lower(F.trim(F.coalesce(x["image_type"], F.lit("image"))))
        what = F.when(named == "chart", "chart").otherwise("image")
        text = F.replace(F.trim(F.coalesce(x["description"], F.lit(""))), F.lit('"'), F.lit("「"))
        marked = F.when((what == "chart") & (text != "") & ~text.startswith(CHART_MARK), F.concat(F.lit(CHART_MARK + " "), text)).otherwise(text)
        return F.struct(F.trim(x["path"]).alias("path"), what.alias("image_type"), marked.alias("description"))

    return F.struct(F.size(known).alias("reviewed"), F.transform(F.filter(known, lambda x: F.coalesce(x["keep"], F.lit(True))), one).alias("insights"))


def captions(images: Column, insights: Column, title: Column) -> Column:
    """array of struct(path, caption, kind): an article's images with their insights, by path; the last of equal paths counts. Without one the title is the caption."""

    def one(path: Column) -> Column:
        own = F.element_at(F.filter(F.concat(F.array(F.lit(None).cast("struct<path:string,image_type:string,description:string>")), insights), lambda x: F.coalesce(x["path"] == path, x.isNull())), -1)
        return F.struct(path.alias("path"), F.coalesce(F.nullif(own["description"], F.lit("")), title, F.lit("")).alias("caption"), F.when(own["image_type"] == "chart", "chart").otherwise("image").alias("kind"))

    return F.transform(F.coalesce(images, F.array().cast("array<string>")), one)
