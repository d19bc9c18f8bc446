"""Articles: from page text to cleaned and merged rows.

An article row has issue, page, ordinal, title, body and category. Operators keep to one issue or
page, whose size an issue of a periodical bounds, and never rely on the order of rows: ordinal orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.functions import vocabulary as V
from broadsheet.operators import folds


def from_documents(docs: DataFrame, page_rows: int = 100) -> DataFrame:
    """Documents as articles: the first line is the title, the rest the body; page_rows ids make a page."""
    text = F.coalesce("text", F.lit(""))
    title = X.strip(F.substring_index(text, "\n", 1))
    body = X.strip(F.substring(text, F.instr(F.concat(text, F.lit("\n")), "\n") + 1, F.length(text)))
    page = F.expr(f"doc_id div {page_rows}")
    return docs.select(F.col("doc_id").alias("ordinal"), F.col("source").alias("issue"), page.alias("page"), title.alias("title"), body.alias("body"), F.col("lang").alias("category"))


def any_phrase(key: Column, phrases: Sequence[str]) -> Column:
    """Whether a normalised text holds one of the phrases."""

    def held(k: Column) -> Column:
        out = F.lit(False)
        for p in phrases:
            out = out | F.contains(k, F.lit(p))
        return out

    return X.once(key, held)


def is_advertisement(title: Column, category: Column, body: Column, phrases: Sequence[str] = V.AD_PHRASES) -> Column:
    near = X.label_key(F.concat_ws(" ", title, F.left(body, F.lit(1200))))
    return X.label_key(F.coalesce(category, F.lit(""))).isin(*V.AD_CATEGORIES) | any_phrase(near, phrases)


def is_service_block(title: Column, category: Column, body: Column, phrases: Sequence[str] = V.SERVICE_PHRASES) -> Column:
    return any_phrase(X.label_key(F.concat_ws(" ", title, category, F.left(body, F.lit(500)))), phrases)


def is_teaser(title: Column, body: Column, min_words: int = V.MIN_WORDS) -> Column:
    """A short text that names a page and mostly repeats its title."""
    own = F.array_distinct(F.filter(F.split(X.label_key(title), " "), lambda t: t != ""))
    body_words = F.array_distinct(F.split(X.label_key(body), " "))
    shared = F.size(F.array_intersect(own, body_words))
    named = body.rlike("(?i)\\b(?:page|pages|p)[ \\t-\\r]*[0-9]+\\b")
    mostly = (F.size(own) > 0) & (shared >= F.greatest(F.lit(2), F.floor(F.size(own) / 2)))
    return named & mostly & (X.word_count(body) < max(V.TEASER_WORDS, 2 * min_words))


def reject_reason(title: Column, category: Column, body: Column, bypass: Column | None = None, min_words: int = V.MIN_WORDS, ads: Sequence[str] = V.AD_PHRASES, services: Sequence[str] = V.SERVICE_PHRASES) -> Column:
    """Why an article isn't one; null if it is. The first reason in this order counts."""
    title, category, body = (F.coalesce(c, F.lit("")) for c in (title, category, body))
    empty = F.length(X.strip(body)) == 0
    bypass = F.coalesce(bypass, F.lit(False)) if bypass is not None else F.lit(False)
    return (
        F.when(bypass & empty, "empty")
        .when(bypass, F.lit(None))
        .when(X.label_key(title).isin(*V.BLOCKED_TITLES), "blocked title")
        .when(is_advertisement(title, category, body, ads), "advertisement")
        .when(empty, "empty")
        .when(X.word_count(body) < min_words, "short")
        .when(is_teaser(title, body, min_words), "teaser")
        .when(is_service_block(title, category, body, services), "service")
    )


def clean(articles: DataFrame, **options) -> DataFrame:
    return articles.where(reject_reason(F.col("title"), F.col("category"), F.col("body"), **options).isNull())


def unrepairable(title: Column, category: Column, body: Column) -> Column:
    """Articles that no repair is tried for."""
    blocked = X.label_key(title).isin(*V.BLOCKED_TITLES) | X.label_key(F.coalesce(category, F.lit(""))).isin(*V.BLOCKED_TITLES)
    return blocked | is_service_block(title, category, body)


def fold_bodies(parts: Column, overlap: float = V.FRAGMENT_OVERLAP) -> Column:
    """Joins an ordered array of struct(title, body): a body is left out if that share of its tokens is there; another title becomes a subheading."""

    def add(s: Column, p: Column) -> Column:
        known = X.containment(X.tokens(p["body"]), X.tokens(s["body"])) >= overlap
        head = F.when((X.label_key(p["title"]) != X.label_key(s["title"])) & (p["title"] != ""), F.concat(F.lit("\n\n### "), p["title"])).otherwise("")
        grown = F.when(s["body"] == "", p["body"]).when((p["body"] == "") | known, s["body"]).otherwise(F.concat(s["body"], head, F.lit("\n\n"), p["body"]))
        return F.struct(s["title"].alias("title"), grown.alias("body"))

    first = F.struct(F.get(parts, F.lit(0))["title"].alias("title"), F.get(parts, F.lit(0))["body"].alias("body"))
    return F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), first, add, lambda s: s["body"])


def _merged(articles: DataFrame, keys: Sequence[str], overlap: float) -> DataFrame:
    group = ["issue", "page", *keys]
    pieces = folds.new_pieces(articles.select(*group, "ordinal", "title", "body"), group, ["ordinal"], overlap)
    first = F.min_by("title", "ordinal").alias("title")
    return pieces.groupBy(*group).agg(F.min("ordinal").alias("ordinal"), first, folds.joined_pieces(["ordinal"]).alias("body"), F.array_sort(F.collect_list("ordinal")).alias("members")).drop(*keys)


def merge_same_titles(articles: DataFrame, overlap: float = V.FRAGMENT_OVERLAP) -> DataFrame:
    """One row for each title of a page, bodies folded in order; blank titles stay apart."""
    key = X.label_key(F.coalesce("title", F.lit("")))
    keyed = articles.withColumn("_key", F.when(key == "", F.concat(F.lit("\u0001"), F.col("ordinal").cast("string"))).otherwise(key))
    return _merged(keyed, ["_key"], overlap)


def merge_related(articles: DataFrame, images: str = "images", overlap: float = V.FRAGMENT_OVERLAP) -> DataFrame:
    """One row for each (category, set of images) of a page; rows without images stay apart."""
    sorted_images = F.array_join(F.array_sort(F.array_distinct(F.col(images))), "\u0001")
    keyed = articles.withColumn("_sign", F.when(F.size(images) > 0, F.concat_ws("\u0001", X.label_key("category"), sorted_images)).otherwise(F.concat(F.lit("\u0002"), F.col("ordinal").cast("string"))))
    return _merged(keyed, ["_sign"], overlap)


def merge_continued(articles: DataFrame, overlap: float = V.CONTINUATION_OVERLAP) -> DataFrame:
    """Rows marked as continued join the row of the same base title on their page."""
    keyed = articles.withColumn("_base", X.label_key(X.continued_base(F.col("title"))))
    return _merged(keyed, ["_base"], overlap)


def suspicious_pairs(articles: DataFrame, share: float = 0.75) -> DataFrame:
    """Neighbours on a page whose titles overlap by that share of the shorter: candidates for a review."""
    order = Window.partitionBy("issue", "page").orderBy("ordinal")
    own = F.array_distinct(X.tokens(F.col("title")))
    both = articles.withColumn("own", own).withColumn("before", F.lag("own").over(order)).withColumn("before_ordinal", F.lag("ordinal").over(order))
    ratio = F.size(F.array_intersect("own", "before")) / F.greatest(F.least(F.size("own"), F.size("before")), F.lit(1))
    return both.filter(F.col("before").isNotNull() & (ratio >= share)).select("issue", "page", F.col("before_ordinal").alias("first"), F.col("ordinal").alias("second"))


def exact_continuations(articles: DataFrame) -> DataFrame:
    """For each article the latest earlier one of its issue with the same title key on another page.

    The last row of each page and title, carried forward over pages: as-of by order, without a join
    of all pairs.
    """
    keyed = articles.withColumn("key", X.label_key("title")).filter("key <> ''")
    ends = keyed.groupBy("issue", "key", "page").agg(F.max("ordinal").alias("last"))
    by = Window.partitionBy("issue", "key").orderBy("page")
    earlier = ends.withColumn("target", F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    return keyed.join(earlier.select("issue", "key", "page", "target"), ["issue", "key", "page"]).filter(F.col("target").isNotNull()).select("issue", "page", "ordinal", "target")


def merge_across_pages(articles: DataFrame, overlap: float = V.CONTINUATION_OVERLAP) -> DataFrame:
    """Articles of an issue with the same title on several pages become one on the first page.

    The exact-title part of the cross-page merge: pages in order, bodies folded, pages listed. Rows
    without a title stay apart. Marks of continuation are stripped before titles are compared.
    """
    base = X.label_key(X.continued_base(F.coalesce("title", F.lit(""))))
    keyed = articles.withColumn("_base", F.when(base == "", F.concat(F.lit("\u0001"), F.col("ordinal").cast("string"))).otherwise(base))
    pieces = folds.new_pieces(keyed.select("issue", "_base", "page", "ordinal", "title", "body"), ["issue", "_base"], ["page", "ordinal"], overlap, title=None)
    first = F.struct("page", "ordinal")
    merged = pieces.groupBy("issue", "_base").agg(F.min(first).alias("f"), X.continued_base(F.min_by("title", first)).alias("title"), folds.joined_pieces(["page", "ordinal"]).alias("body"), F.array_sort(F.collect_set("page")).alias("source_pages"))
    return merged.select("issue", "f.page", "f.ordinal", "title", "body", "source_pages")


def merge_continuations(articles: DataFrame, overlap: float = V.CONTINUATION_OVERLAP) -> DataFrame:
    """The cross-page merge of an issue: rows that continue an article (folds.continuation_targets) join it.

    Bodies are left out where that share of their tokens is there; pages, images and block ids (columns
    source_pages, images and source_block_ids, where there are such) are united in order. A row that is
    marked as continued but continues nothing gets the title that its mark names.
    """
    names = articles.columns
    targets = folds.continuation_targets(articles)
    said = X.strip(F.coalesce("continuation_of", F.lit(""))) if "continuation_of" in names else F.lit("")
    flag = F.coalesce("is_continuation", F.lit(False)) if "is_continuation" in names else F.lit(False)
    plain = X.or_else(X.continued_base(F.coalesce("title", F.lit(""))), F.col("title"))
    marked = flag | (said != "") | X.is_continued(F.coalesce("title", F.lit("")))
    named = targets.withColumn("title", F.when(marked, F.when(said != "", said).otherwise(plain)).otherwise(F.col("title"))).withColumn("body", X.strip(F.coalesce("body", F.lit(""))))
    own_pages = F.array("page") if "source_pages" not in names else F.when(F.size("source_pages") > 0, F.col("source_pages")).otherwise(F.array("page"))
    lists = {"source_pages": own_pages, **{c: F.col(c) for c in ("images", "source_block_ids") if c in names}}
    named = named.withColumns({f"_{k}": F.coalesce(v, F.array().cast(named.select(v.alias("v")).schema["v"].dataType)) for k, v in lists.items()})
    pieces = folds.new_pieces(named.select("issue", "target", "page", "ordinal", "title", "body", *[f"_{k}" for k in lists]), ["issue", "target"], ["page", "ordinal"], overlap, title=None)
    order = F.struct("page", "ordinal")
    in_order = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "ordinal", F.col(c).alias("v")))), lambda x: x["v"]))
    united = [(in_order(f"_{k}") if k == "source_block_ids" else F.array_distinct(in_order(f"_{k}"))).alias(k) for k in lists]
    merged = pieces.groupBy("issue", "target").agg(F.min(order).alias("f"), F.min_by("title", order).alias("title"), folds.joined_pieces(["page", "ordinal"]).alias("body"), *united)
    return merged.select("issue", "f.page", "f.ordinal", "title", "body", *lists)


def reindex(articles: DataFrame) -> DataFrame:
    """article_index over an issue and page_article_index over a page, from 1."""
    issue = Window.partitionBy("issue").orderBy("page", "ordinal")
    page = Window.partitionBy("issue", "page").orderBy("ordinal")
    return articles.withColumn("article_index", F.row_number().over(issue).cast("long")).withColumn("page_article_index", F.row_number().over(page).cast("long"))


def page_groups(articles: DataFrame) -> DataFrame:
    """One row for each page with its articles' ordinals in order and the first title."""
    found = F.array_sort(F.collect_list("ordinal"))
    return articles.groupBy("issue", "page").agg(found.alias("ordinals"), F.min(F.struct("ordinal", "title"))["title"].alias("first_title"))


def compile_budget(body: Column, least: int = 5000, most: int = 7000) -> Column:
    """Tokens to allow an enrichment call: 3500 and 3.5 a word, within limits."""
    return F.greatest(F.lit(least), F.least(F.lit(most), F.floor(3500 + 3.5 * X.word_count(body)))).cast("long")


def summary_band(words: Column) -> Column:
    """Lower and upper bound of a summary's length for a text of so many words."""
    return F.when(words <= 900, F.struct(F.lit(420).alias("low"), F.lit(650).alias("high"))).when(words <= 1800, F.struct(F.lit(520).alias("low"), F.lit(800).alias("high"))).otherwise(F.struct(F.lit(620).alias("low"), F.lit(1000).alias("high")))


def needs_compile(row: DataFrame) -> Column:
    """Rows with a body that no enrichment has completed: flag, or title, summary and a translated paragraph."""
    done = F.coalesce(F.col("compiled_article"), F.lit(False)) | ((F.coalesce("title_zh", F.lit("")) != "") & (F.coalesce("summary_md", F.lit("")) != "") & F.exists("paragraphs", lambda p: F.coalesce(p["zh_text"], F.lit("")) != ""))
    return (F.length(X.strip(F.coalesce("body", F.lit("")))) > 0) & ~done


def page_fallback(page_text: Column, page: Column) -> Column:
    """The article that a page without a split becomes: a guessed title and the whole text."""
    title = F.coalesce(X.guess_title(page_text), F.format_string("Page %d OCR Text", page))
    return F.struct(title.alias("title"), page_text.alias("body"))


def profile(articles: DataFrame, most: int = 180) -> DataFrame:
    """What a reviewer of a page's articles is shown: number, title, category, words, beginning and end."""
    flat = F.regexp_replace(F.coalesce("body", F.lit("")), "[ \\t-\\r]+", " ")
    order = Window.partitionBy("issue", "page").orderBy("ordinal")
    return articles.select("issue", "page", F.row_number().over(order).cast("long").alias("number"), "title", "category", X.word_count(F.coalesce("body", F.lit(""))).alias("word_count"), F.left(flat, F.lit(most)).alias("start"), F.right(flat, F.lit(most)).alias("end"))


def paragraphs_of(paragraphs: Column, body: Column) -> Column:
    """An article's paragraphs: the structured ones if any has text, else its body at blank lines."""
    kept = F.filter(paragraphs, lambda p: X.strip(F.coalesce(p["en_text"], F.lit(""))) != "")
    plain = F.transform(X.paragraphs(F.coalesce(body, F.lit(""))), lambda t: F.struct(t.alias("en_text"), F.lit("").alias("zh_text"), F.lit("body").alias("role")))
    return F.when(F.size(kept) > 0, kept).otherwise(plain)


def fallback_body(start: Column, end: Column) -> Column:
    """A body where a slice by anchors was not to be had."""
    return X.strip(F.concat(X.strip(F.coalesce(start, F.lit(""))), F.lit(" ... "), X.strip(F.coalesce(end, F.lit("")))))


def numbered(paragraphs: Column) -> Column:
    """Paragraphs as a numbered list for a prompt."""
    return F.array_join(F.transform(paragraphs, lambda p, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), p)), "\n\n")
