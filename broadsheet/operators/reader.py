"""The reader's queries over issues, pages and articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def search_text(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *parts))


def search(rows: DataFrame, haystack: Column, query: str) -> DataFrame:
    """Rows whose search text holds the query, case aside; a blank query finds all."""
    return rows.filter(F.contains(haystack, F.lit(query.strip().lower()))) if query.strip() else rows


def publication_summary(index: DataFrame) -> DataFrame:
    """Per publication: issues, articles, and the newest issue (the larger id on the same day)."""
    newest = F.max(F.struct("publication_date", "id"))
    return index.groupBy("publication_type").agg(F.count(F.lit(1)).alias("issues"), F.sum("article_count").alias("articles"), newest["id"].alias("latest_id"), newest["publication_date"].alias("latest_date"))


def category_contents(articles: DataFrame) -> DataFrame:
    """Categories of an issue in first-seen order, with counts."""
    found = articles.groupBy("issue", "category").agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first"))
    return found.withColumn("position", F.row_number().over(Window.partitionBy("issue").orderBy("first")).cast("long")).drop("first")


def neighbours(articles: DataFrame) -> DataFrame:
    """Previous and next article of an issue."""
    by = Window.partitionBy("issue").orderBy("ordinal")
    return articles.withColumn("previous", F.lag("ordinal").over(by)).withColumn("next", F.lead("ordinal").over(by))


UNKNOWN_SECTION, UNKNOWN_PAGE = "Section unknown", "PDF page unknown"


def page_label(section: Column, label: Column, page: Column, origin: Column) -> Column:
    """A page's label, its PDF page, or its section where only that is printed."""
    s, n = (F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit("")) for c in (section, label))
    pdf = F.when(page > 0, F.format_string("PDF %d", page)).otherwise(UNKNOWN_PAGE)
    return F.when(F.coalesce(origin, F.lit("")) == "section_only", F.coalesce(s, F.lit(UNKNOWN_SECTION))).otherwise(F.coalesce(n, pdf))


def page_heading(section: Column, label: Column, page: Column, origin: Column) -> Column:
    """What a page is called: its label and its section in headline case."""
    shown = F.nullif(display_case(F.trim(F.coalesce(section, F.lit("")))), F.lit(""))
    both = F.concat(page_label(section, label, page, origin), F.lit(" · "), F.coalesce(shown, F.lit(UNKNOWN_SECTION)))
    return F.when(F.coalesce(origin, F.lit("")) == "section_only", page_label(section, label, page, origin)).otherwise(both)


# Words that display_case keeps small, and acronyms that it keeps large.
SMALL_WORDS = ("a", "an", "and", "at", "by", "for", "in", "of", "on", "or", "the", "to", "with")
ACRONYMS = ("AI", "CEO", "CFO", "EU", "UK", "U.K.")


def display_case(text: Column) -> Column:
    """Headline case of an upper-case name: small words small but for the first, acronyms large; other names as they are."""

    def one(word: Column, i: Column) -> Column:
        low = F.lower(word)
        first = F.regexp_extract(low, "^([^a-z]*)", 1)
        at = F.length(first)
        capital = F.concat(first, F.upper(F.substring(low, at + 1, F.lit(1))), F.substring(low, at + 2, F.length(low)))
        return F.when(F.upper(word).isin(*ACRONYMS), F.upper(word)).when((i > 0) & low.isin(*SMALL_WORDS), low).otherwise(capital)

    cased = F.array_join(F.transform(F.split(F.regexp_replace(text, " +", " "), " "), one), " ")
    return F.when((F.upper(text) == text) & text.rlike("[A-Z]"), cased).otherwise(text)


def pages_from_articles(articles: DataFrame) -> DataFrame:
    """Pages made up for an issue without any: one for each (label, section, page) in first-seen order."""
    found = articles.groupBy("issue", "label", "section", "page").agg(F.min("ordinal").alias("first"), F.count(F.lit(1)).alias("n"))
    return found.withColumn("page_order", F.row_number().over(Window.partitionBy("issue").orderBy("first")).cast("long"))


def primary_page(articles: DataFrame, pages: DataFrame) -> DataFrame:
    """(issue, ordinal, pdf_page, how): an article's page by label, else by PDF page, else the issue's last."""
    by_label = pages.groupBy("issue", F.upper("label").alias("_label")).agg(F.min("pdf_page").alias("_by_label"))
    numbers = pages.select("issue", F.col("pdf_page").alias("page"), F.col("pdf_page").alias("_by_page")).distinct()
    last = pages.groupBy("issue").agg(F.max("pdf_page").alias("_last"))
    a = articles.withColumn("_label", F.upper("label"))
    joined = a.join(by_label, ["issue", "_label"], "left").join(numbers, ["issue", "page"], "left").join(last, "issue", "left")
    how = F.when(F.col("_by_label").isNotNull(), "label").when(F.col("_by_page").isNotNull(), "page").otherwise("last")
    return joined.select("issue", "ordinal", F.coalesce("_by_label", "_by_page", "_last").alias("pdf_page"), how.alias("how"))


def annotations_of(annotations: DataFrame, glossary: DataFrame) -> DataFrame:
    """Annotations with their entries, by paragraph, longer surfaces first."""
    by = Window.partitionBy("article").orderBy("paragraph", F.length("surface").desc(), "glossary_id")
    return annotations.join(glossary, "glossary_id").withColumn("place", F.row_number().over(by).cast("long"))


def default_publication(url: Column, saved: Column, newest: Column) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.nullif(saved, F.lit("")), newest)


def asset_path(root: Column, database_path: Column, relative: Column) -> Column:
    """Address of an asset: its root, the folder of the issue's file, the relative path."""
    folder = F.regexp_replace(database_path, "[^/]*$", "")
    return F.regexp_replace(F.concat(F.regexp_replace(root, "/*$", "/"), folder, F.regexp_replace(relative, "^\\./", "")), "(?<!:)/{2,}", "/")


def local_summary(article: DataFrame) -> Column:
    """What is shown of an article that no model has read: its place, category, page and number of words. Columns label, section, category, page, body, compiled."""
    words = F.size(F.filter(F.split(F.coalesce(article["body"], F.lit("")), "[ \\t-\\r]+"), lambda w: w != ""))
    place = F.concat_ws(" · ", F.nullif(article["label"], F.lit("")), F.nullif(article["section"], F.lit("")))
    # The wording.
    lines = [
        F.lit("### 基本信息"),
        F.concat(F.lit("- 版面："), F.coalesce(F.nullif(place, F.lit("")), F.lit("未知"))),
        F.concat(F.lit("- 分类："), F.coalesce(F.nullif(article["category"], F.lit("")), F.lit("General"))),
        F.concat(F.lit("- PDF 页码："), F.coalesce(F.nullif(article["page"], F.lit(0)).cast("string"), F.lit("未知"))),
        F.concat(F.lit("- 正文字数：约 "), words.cast("string"), F.lit(" words")),
        F.lit(""),
        F.lit("### 处理状态"),
        F.when(F.coalesce(article["compiled"], F.lit(False)), "- 已完成 LLM 结构化编译。").otherwise("- 当前文章使用本地段落整理，暂无中文深度解读。"),
    ]
    return F.concat_ws("\n", *lines)


def page_articles(articles: DataFrame, pages: DataFrame) -> DataFrame:
    """(issue, pdf_page, page_order, article_ids, is_fallback): an issue's pages with their articles, by stages.

    articles: issue, ordinal, id, page, label, source_pages; pages: issue, pdf_page, page_order, label.
    An article goes to every page that it names; if there is none, to the first page of its label, else
    to its PDF page; what is left goes to a page made up after the last, whose pdf_page is null. Each
    stage is a join of what the stage before has left.
    """
    named = articles.withColumn("on", F.explode_outer(F.array_distinct(F.filter(F.concat(F.coalesce("source_pages", F.array().cast("array<long>")), F.array(F.col("page").cast("long"))), lambda p: p > 0))))
    numbers = pages.select("issue", F.col("pdf_page").cast("long").alias("on")).distinct()
    first = named.join(numbers, ["issue", "on"]).select("issue", F.col("on").alias("pdf_page"), "ordinal", "id")
    left = articles.join(first.select("issue", "id").distinct(), ["issue", "id"], "left_anti")
    key = lambda c: F.nullif(F.upper(F.trim(F.coalesce(c, F.lit("")))), F.lit(""))
    labels = pages.withColumn("_l", key(F.col("label"))).filter("_l is not null").groupBy("issue", "_l").agg(F.min_by("pdf_page", "page_order").cast("long").alias("pdf_page"))
    second = left.withColumn("_l", key(F.col("label"))).join(labels, ["issue", "_l"], "left")
    found = first.unionByName(second.filter("pdf_page is not null").select("issue", "pdf_page", "ordinal", "id"))
    rest = second.filter("pdf_page is null").groupBy("issue").agg(F.array_sort(F.collect_list(F.struct("ordinal", "id"))).alias("_a"))
    per_page = found.groupBy("issue", "pdf_page").agg(F.array_sort(F.collect_set(F.struct("ordinal", "id"))).alias("_a"))
    ids = F.coalesce(F.transform("_a", lambda a: a["id"]), F.array().cast(per_page.select(F.transform("_a", lambda a: a["id"]).alias("x")).schema["x"].dataType))
    own = pages.withColumn("pdf_page", F.col("pdf_page").cast("long")).join(per_page, ["issue", "pdf_page"], "left").select("issue", "pdf_page", F.col("page_order").cast("long").alias("page_order"), ids.alias("article_ids"), F.lit(False).alias("is_fallback"))
    last = pages.groupBy("issue").agg(F.max("page_order").alias("_last"))
    made = rest.join(last, "issue", "left").select("issue", F.lit(None).cast("long").alias("pdf_page"), (F.coalesce("_last", F.lit(0)) + 1).cast("long").alias("page_order"), F.transform("_a", lambda a: a["id"]).alias("article_ids"), F.lit(True).alias("is_fallback"))
    return own.unionByName(made)
