"""Sinks: issue databases, checkpoints and Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import or_else


def issue_json(*columns: str) -> Column:
    """Columns as a JSON object in this order, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_issue_databases(issues: DataFrame, path: str, variable: str = "window.paper_databases") -> None:
    """A script-wrapped JSON file row for each issue, in folders by type and date. Spark's commit makes it atomic.

    issues: publication_type, publication_date, id and payload (JSON).
    """
    value = F.concat(F.lit(f"{variable} = {variable} || {{}}; {variable}["), F.to_json(F.array("id")).substr(F.lit(2), F.length(F.to_json(F.array("id"))) - 2), F.lit("] = "), F.col("payload"), F.lit(";"))
    issues.select("publication_type", "publication_date", value.alias("value")).write.mode("overwrite").partitionBy("publication_type", "publication_date").text(path)


def write_checkpoints(pages: DataFrame, path: str) -> None:
    """Page results by issue and page, each replacing what was there; rows with an error are never written."""
    pages.filter(F.col("error").isNull()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("issue", "page").parquet(path)


def write_pages_only(articles: DataFrame, path: str) -> None:
    """Replaces the pages that occur in articles and no others."""
    articles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("issue", "page").parquet(path)


def article_markdown(title: Column, category: Column, page: Column, body: Column, images: Column | None = None) -> Column:
    """An article with its header; parts that are missing leave no line."""
    head = F.concat(F.lit("# "), or_else(title, F.lit("Untitled")))
    meta = [F.when(F.coalesce(category, F.lit("")) != "", F.concat(F.lit("- Category: "), category)), F.when(page.isNotNull(), F.format_string("- Page: %d", page))]
    pictures = [F.array_join(F.transform(images, lambda x: F.concat(F.lit("![]("), x, F.lit(")"))), "\n")] if images is not None else []
    return F.concat_ws("\n\n", head, F.nullif(F.concat_ws("\n", *meta), F.lit("")), F.nullif(body, F.lit("")), *[F.nullif(p, F.lit("")) for p in pictures])


def issue_markdown(articles: DataFrame) -> DataFrame:
    """(issue, markdown): an issue's articles in order. An issue bounds the group."""
    text = article_markdown(F.col("title"), F.col("category"), F.col("page"), F.col("body"))
    rows = articles.select("issue", F.struct("page", "ordinal", text.alias("text")).alias("a"))
    return rows.groupBy("issue").agg(F.array_join(F.transform(F.array_sort(F.collect_list("a")), lambda a: a["text"]), "\n\n").alias("markdown"))


def asset_index(images: Column) -> Column:
    """The body of an article that could not be parsed: a list of its images."""
    return F.array_join(F.transform(F.array_sort(images), lambda x: F.concat(F.lit("- "), x)), "\n")


def cover_image(images: DataFrame) -> DataFrame:
    """(issue, cover): cover.jpg, else the first figure of page 1."""
    name = F.regexp_extract("path", "([^/]*)$", 1)
    cover = F.min(F.when(name == "cover.jpg", F.col("path")))
    figure = F.min(F.when(name.startswith("page_1_fig_"), F.col("path")))
    return images.groupBy("issue").agg(F.coalesce(cover, figure).alias("cover"))


def unseen_categories(rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """dimension with the categories of rows that it lacks, names empty, after the others."""
    seen = rows.filter(F.coalesce("category", F.lit("")) != "").groupBy("category").agg(F.lit("").alias("name"))
    new = seen.join(dimension.select("category"), "category", "left_anti").select("category", "name", F.lit(None).cast("long").alias("position"))
    return dimension.select("category", "name", F.col("position").cast("long").alias("position")).unionByName(new)


def write_in_two_phases(pages: DataFrame, path: str, finish) -> DataFrame:
    """Writes page results as they come, then the whole issue: what finish makes of all provisional pages replaces them.

    A reader of path/provisional sees pages early; path/final holds whole issues only, by Spark's commit.
    A repeated run replaces the same partitions. Returns the final table.
    """
    spark = pages.sparkSession
    write_checkpoints(pages, f"{path}/provisional")
    finish(spark.read.parquet(f"{path}/provisional")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("issue").parquet(f"{path}/final")
    return spark.read.parquet(f"{path}/final")
