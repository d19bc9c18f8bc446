"""Page plans: special pages, local layout and magazine pages to articles, without any model.

blocks: page, ordinal, id, x0, y0, x1, y1, text, max_font_size, median_font_size, width, height.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.functions import vocabulary as V
from broadsheet.operators import layout

# Titles and sections of the special world pages.
WORLD_LABELS = {"world_this_week_politics": "Politics", "world_this_week_business": "Business"}
# Magazine sections whose pages have a layout of their own.
COMPLEX_SECTIONS = ("REVIEW & PREVIEW", "MARKET WEEK", "MARKET VIEW", "RETIREMENT MAILBAG", "INSIDE SCOOP")
RUNNING_HEAD = "^[0-9]+ the economist (?:january|february|march|april|may|june|july|august|september|october|november|december) [0-9]+(?:st|nd|rd|th) [0-9]{4}$"


def native_heading(blocks: DataFrame, publications: DataFrame) -> DataFrame:
    """(page, publication, kind): page type from large blocks at the top, in their order."""
    rows = blocks.join(publications, "page")
    magazine = F.upper(F.trim(F.coalesce("publication", F.lit("")))) == "BARRONS"
    top = F.when(magazine, F.least(F.lit(180.0), 0.24 * F.col("height"))).otherwise(F.least(F.lit(100.0), 0.16 * F.col("height")))
    seen = (F.col("y0") <= top) & (F.col("max_font_size") >= F.when(magazine, 8).otherwise(13))
    parts = F.transform(F.array_sort(F.collect_list(F.when(seen, F.struct("ordinal", "text")))), lambda x: x["text"])
    return rows.groupBy("page", "publication").agg(F.array_join(parts, "\n").alias("heading")).select("page", "publication", layout.page_type(F.col("heading"), F.col("publication")).alias("kind"))


def ocr_heading(text: Column, publication: Column) -> Column:
    """Page type from the first 16 lines of recognised text."""
    return layout.page_type(F.array_join(F.slice(X.lines(text), 1, 16), "\n"), publication)


def is_world_block(text: Column, y0: Column, y1: Column, height: Column, font: Column, kind: Column) -> Column:
    """Blocks of a world page that are text: neither margin, title, running head nor small print."""
    key = X.heading_key(text)
    return (F.length(X.strip(text)) > 0) & (y0 >= 72) & (y1 <= height - 12) & (key != _world_title(kind)) & ~key.rlike(RUNNING_HEAD) & (font >= 5)


def _world_title(kind: Column) -> Column:
    return F.lower(F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in WORLD_LABELS.items()], F.lit("")))


def world_pages(blocks: DataFrame, kinds: DataFrame) -> DataFrame:
    """One article for each world page: its blocks by four columns from the top, exempt from the least length."""
    rows = blocks.join(kinds.filter(F.col("kind").isin(*WORLD_LABELS)), "page")
    rows = rows.filter(is_world_block(F.col("text"), F.col("y0"), F.col("y1"), F.col("height"), F.col("max_font_size"), F.col("kind")))
    part = F.struct(layout.quarter_column(F.col("x0"), F.col("width")).alias("c"), "y0", "x0", "ordinal", X.flatten_lines(F.col("text")).alias("t"))
    found = rows.groupBy("page", "kind").agg(F.array_sort(F.collect_list(part)).alias("p"))
    title = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in WORLD_LABELS.items()])
    return found.select("page", title.alias("title"), F.lit("THE WORLD THIS WEEK").alias("category"), F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("body"), F.lit(True).alias("bypass"))


def strip_page_chrome(text: Column, kind: Column) -> Column:
    """Recognised text without blank lines, the page's title and running heads."""
    kept = F.filter(X.lines(text), lambda x: (X.heading_key(x) != _world_title(kind)) & ~X.heading_key(x).rlike(RUNNING_HEAD))
    return F.array_join(kept, "\n")


def local_articles(blocks: DataFrame, least_words: int = 50) -> DataFrame:
    """Articles of a page by geometry alone: headings by font, blocks by their nearest heading above.

    A heading's font is 1.45 times the page's median and 11 at least. Blocks are read by x in steps
    of 20, then y.
    """
    page = Window.partitionBy("page")
    median = F.coalesce(F.median(F.when(F.col("median_font_size") > 0, F.col("median_font_size"))).over(page), F.lit(8.0))
    rows = blocks.withColumn("limit", F.greatest(F.lit(11.0), 1.45 * median))
    rows = rows.withColumn("head", layout.is_heading(F.col("text"), F.col("max_font_size"), F.col("y0"), F.col("height"), F.col("limit")))
    headings, others = rows.filter("head"), rows.filter("not head")
    owned = others.join(layout.assign_headings(others, headings), ["page", "id"])
    part = F.struct(F.bround(F.col("x0") / 20).alias("c"), "y0", "ordinal", "id", X.flatten_lines(F.col("text")).alias("t"))
    bodies = owned.groupBy("page", "heading").agg(F.array_sort(F.collect_list(part)).alias("p"))
    out = bodies.select("page", "heading", F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("body"), F.transform("p", lambda x: x["id"]).alias("block_ids"))
    titles = headings.select("page", F.col("id").alias("heading"), F.col("ordinal"), X.flatten_lines(F.col("text")).alias("title"))
    return titles.join(out, ["page", "heading"]).filter(X.word_count(F.col("body")) >= least_words).select("page", "ordinal", "title", "body", "block_ids")


def drop_cap(text: Column) -> Column:
    """The lone capital on a block's last line, else the empty string."""
    return F.regexp_extract(text, "(?s)(?:^|\\n)[ \\t]*([A-Z])[ \\t-\\r]*$", 1)


def headline_text(text: Column, split=None) -> Column:
    """A headline without a trailing drop cap, with its spacing repaired.

    split: an optional function of a text column that parts glued words.
    """
    bare = F.regexp_replace(text, "(?s)(?:\\n[ \\t]*[A-Z][ \\t]*)+[ \\t-\\r]*$", "")
    out = F.regexp_replace(X.squeeze(bare), "- +", "-")
    for pattern, put in (("([,;:])(?=[A-Za-z])", "$1 "), ("([.!?])(?=[A-Z])", "$1 "), ("([A-Za-z])(?=\\$)", "$1 "), ("([0-9])(?=[A-Za-z])", "$1 ")):
        out = F.regexp_replace(out, pattern, put)
    for acronym in ("CEO", "ETF", "SEC", "AI"):
        out = F.regexp_replace(F.regexp_replace(out, f"(?<![A-Z])({acronym})(?=[A-Z][a-z])", "$1 "), f"(?<=[a-z])({acronym})", " $1")
    return X.squeeze(split(out) if split else out)


def is_promotion(text: Column) -> Column:
    key = F.lower(X.squeeze(text))
    out = F.lit(True)
    for phrase in V.PODCAST_PROMOTION:
        out = out & F.contains(key, F.lit(phrase))
    return out


def is_headline(title: Column, x0: Column, y0: Column, x1: Column, median: Column, largest: Column, width: Column, height: Column) -> Column:
    """Blocks fit for a magazine page's headline."""
    n = X.word_count(title)
    placed = y0.between(0.035 * height, 0.72 * height) & (x1 - x0 >= 0.18 * width)
    large = (median >= 20) & ((median >= 24) | (largest >= 40))
    label = (F.upper(title) == title) & (n <= 8)
    promo = F.contains(X.heading_key(title), F.lit(V.HEADLINE_PROMOTIONS[0])) | F.contains(X.heading_key(title), F.lit(V.HEADLINE_PROMOTIONS[1]))
    return placed & large & n.between(2, 24) & ~label & title.rlike("^[A-Za-z0-9]") & ~promo


def magazine_sections(blocks: DataFrame) -> DataFrame:
    """(page, section, category): first capitals of a page's top that name its section, and its category."""
    flat = X.flatten_lines(F.col("text"))
    n = F.size(F.filter(F.split(flat, " "), lambda w: w != ""))
    high = (F.col("y0") < 0.14 * F.col("height")) & (F.upper(flat) == flat)
    first = lambda c: F.min(F.when(high & c, F.struct("ordinal", flat.alias("t"))))["t"]
    return blocks.groupBy("page").agg(F.coalesce(first((F.col("median_font_size") >= 18) & n.between(1, 8)), F.lit("")).alias("section"), F.coalesce(first((F.col("max_font_size") >= 14) & n.between(2, 8)), F.lit("Barron's")).alias("category"))


def column_text(blocks: DataFrame, body: DataFrame) -> DataFrame:
    """(page, body, block_ids) of body blocks by columns, with drop caps put back, those of blocks included."""
    placed = body.join(layout.column_order(body.select("page", "id", "x0", "y0")), ["page", "id"])
    by = Window.partitionBy("page").orderBy("place")
    flat = X.flatten_lines(F.col("text"))
    moved = F.when((F.col("max_font_size") >= 30) & F.lead(flat).over(by).rlike("^[a-z]"), drop_cap(F.col("text"))).otherwise("")
    placed = placed.withColumn("flat", flat).withColumn("gone", moved)
    placed = placed.withColumn("got", F.coalesce(F.lag("gone").over(by), F.lit("")))
    own = F.when(F.col("gone") != "", F.regexp_replace("flat", " +[A-Z]$", "")).otherwise(F.col("flat"))
    parts = placed.withColumn("part", F.when(F.upper(F.left(own, F.lit(1))) == F.col("got"), own).otherwise(F.concat("got", own)))
    lead = leading_drop_cap(blocks, placed)
    whole = parts.groupBy("page").agg(F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("place", "part"))), lambda x: x["part"]), lambda p: p != ""), "\n\n").alias("body"), F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda x: x["id"]).alias("block_ids"))
    out = whole.join(lead, "page", "left").withColumn("cap", F.coalesce("cap", F.lit("")))
    text = F.when(F.upper(F.left("body", F.lit(1))) == F.col("cap"), F.col("body")).otherwise(F.concat("cap", "body"))
    return out.select("page", text.alias("body"), "block_ids")


def body_blocks(blocks: DataFrame) -> DataFrame:
    """The blocks that are text of a magazine's article."""
    cap = (F.col("max_font_size") >= 40) & (F.col("x1") - F.col("x0") <= 180)
    return blocks.filter(layout.is_body_block(X.word_count(F.col("text")), cap, F.col("median_font_size"), F.col("y0"), F.col("height")) & ~is_promotion(F.col("text")))


def complex_articles(blocks: DataFrame, split=None) -> DataFrame:
    """(page, title, category, body, block_ids, bypass_min_words): the main article of a page of one of COMPLEX_SECTIONS.

    The market view is all of its text. Else the headline is the block in the largest type, of the
    mailbag the leftmost; its text stands below it, in the section's own columns, of the inside scoop
    down to the next headline. A market week may have a title only.
    """
    page = Window.partitionBy("page")
    rows = blocks.join(magazine_sections(blocks).select("page", "section"), "page").filter(F.col("section").isin(*COMPLEX_SECTIONS))
    rows = rows.withColumn("title", headline_text(F.col("text"), split))
    large = (F.col("median_font_size") >= 20) & (F.col("max_font_size") >= 24) & X.word_count(F.col("title")).between(2, 24) & (F.upper("title") != F.col("title"))
    mailbag, view, week, scoop = (F.col("section") == x for x in ("RETIREMENT MAILBAG", "MARKET VIEW", "MARKET WEEK", "INSIDE SCOOP"))
    rank = F.when(mailbag, F.col("x0")).otherwise(-F.col("median_font_size"))
    heads = rows.filter(large & ~view).withColumn("r", F.row_number().over(page.orderBy(rank, "ordinal"))).filter("r = 1")
    heads = heads.select("page", F.col("title").alias("head"), F.col("id").alias("head_id"), F.col("y0").alias("hy0"), F.col("y1").alias("hy1"))
    led = rows.join(heads, "page", "left")
    limit = F.col("width") * F.when(mailbag, 0.52).when(F.col("section") == "REVIEW & PREVIEW", 0.56).otherwise(1.0)
    words = F.size(F.regexp_extract_all("text", F.lit("[A-Za-z0-9]+"), F.lit(0)))
    other = (F.col("id") != F.col("head_id")) & (F.col("x0") < 0.55 * F.col("width")) & (F.col("y0") > F.col("hy1") + 20) & (F.col("max_font_size") >= 16) & words.between(2, 20)
    led = led.withColumn("below", F.coalesce(F.min(F.when(other, F.col("y0"))).over(page), F.col("height")))
    placed = (F.col("id") != F.col("head_id")) & (F.col("x0") < limit) & (week | (F.col("y0") >= F.col("hy0") - 4)) & (~scoop | ((F.col("x0") < 0.55 * F.col("width")) & (F.col("y0") < F.col("below"))))
    whole = column_text(blocks, body_blocks(led.filter(view | placed)).select(*blocks.columns))
    pages = rows.select("page", "section").distinct().join(heads, "page", "left").join(whole, "page", "left")
    found = F.size(F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit("[A-Za-z0-9]+"), F.lit(0)))
    kept = pages.filter((view & (found >= 300)) | (F.col("head").isNotNull() & (week | (found >= 40))))
    body = F.when(week, X.or_else(F.col("body"), F.col("head"))).otherwise(F.col("body"))
    return kept.select("page", F.when(view, "Market View").otherwise(F.col("head")).alias("title"), F.col("section").alias("category"), body.alias("body"), F.coalesce("block_ids", F.array().cast(whole.schema["block_ids"].dataType)).alias("block_ids"), week.alias("bypass_min_words"))


def page_status(blocks: DataFrame, split=None, least_words: int = 300) -> DataFrame:
    """(page, status): which of magazine_articles, complex_articles and continuation_pages a page is for, so that none goes unseen.

    skipped: of fewer than least_words words; several: more than one headline, for a split by a model.
    """
    title = headline_text(F.col("text"), split)
    head = is_headline(title, F.col("x0"), F.col("y0"), F.col("x1"), F.col("median_font_size"), F.col("max_font_size"), F.col("width"), F.col("height"))
    n = F.sum(F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z0-9]+"), F.lit(0))))
    found = blocks.groupBy("page").agg(n.alias("words"), F.count_if(head).alias("heads")).join(magazine_sections(blocks), "page")
    status = F.when(is_short_page(F.lit("BARRONS"), F.col("words"), least_words), "skipped").when(F.col("section").isin(*COMPLEX_SECTIONS), "complex").when(F.col("heads") == 1, "simple").when(F.col("heads") == 0, "continuation").otherwise("several")
    return found.select("page", status.alias("status"))


def is_short_page(publication: Column, words: Column, least: int = 300) -> Column:
    """Whether a magazine's page has too little text for an article."""
    return (F.upper(F.trim(publication)) == "BARRONS") & (words < least)


def magazine_articles(blocks: DataFrame, least_words: int = 80, split=None) -> DataFrame:
    """The article of each simple magazine page: exactly one headline, body blocks by columns, drop caps restored.

    Pages of COMPLEX_SECTIONS are for complex_articles, those without a headline for continuation_pages;
    page_status tells, and names those with several.
    """
    page = Window.partitionBy("page")
    rows = blocks.join(magazine_sections(blocks), "page").filter(~F.col("section").isin(*COMPLEX_SECTIONS))
    rows = rows.withColumn("title", headline_text(F.col("text"), split))
    rows = rows.withColumn("headline", is_headline(F.col("title"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("median_font_size"), F.col("max_font_size"), F.col("width"), F.col("height")))
    rows = rows.withColumn("n_headlines", F.count_if("headline").over(page)).filter("n_headlines = 1")
    heads = rows.filter("headline").select("page", F.col("title").alias("page_title"), "category")
    cap = (F.col("max_font_size") >= 40) & (F.col("x1") - F.col("x0") <= 0.24 * F.col("width"))
    body = rows.filter(~F.col("headline") & layout.is_body_block(X.word_count(F.col("text")), cap, F.col("median_font_size"), F.col("y0"), F.col("height")) & ~is_promotion(F.col("text")))
    out = heads.join(column_text(blocks, body), "page")
    return out.select("page", F.col("page_title").alias("title"), "category", "body", "block_ids").filter(X.word_count(F.col("body")) >= least_words)


def leading_drop_cap(blocks: DataFrame, placed: DataFrame) -> DataFrame:
    """(page, cap): the drop cap that belongs to the first body block: nearest above or beside it."""
    first = placed.filter("place = 1").select("page", F.col("x0").alias("fx"), F.col("y0").alias("fy"))
    caps = blocks.filter("max_font_size >= 30").withColumn("cap", drop_cap(F.col("text"))).filter("cap <> ''").join(first, "page")
    near = caps.filter(F.col("fx").between(F.col("x0") - 20, F.col("x1") + 20) & (F.col("y0") <= F.col("fy") + 40) & (F.col("y1") >= F.col("fy") - 180))
    gap = F.when(F.col("fy").between(F.col("y0"), F.col("y1")), 0.0).otherwise(F.least(F.abs(F.col("fy") - F.col("y0")), F.abs(F.col("fy") - F.col("y1"))))
    return near.groupBy("page").agg(F.min(F.struct(gap.alias("g"), F.abs(F.col("fx") - F.col("x0")).alias("d"), "cap"))["cap"].alias("cap"))


def continuation_pages(blocks: DataFrame, articles: DataFrame, issue_of: DataFrame, least_words: int = 300) -> DataFrame:
    """Pages without a headline, with enough body text, as continuations of the article before them in their issue.

    articles: issue, page, title; issue_of: page, issue.
    """
    title = headline_text(F.col("text"))
    marked = blocks.withColumn("headline", is_headline(title, F.col("x0"), F.col("y0"), F.col("x1"), F.col("median_font_size"), F.col("max_font_size"), F.col("width"), F.col("height")))
    bare = marked.groupBy("page").agg(F.bool_or("headline").alias("any")).filter("not any").select("page")
    body = blocks.join(bare, "page", "left_semi").filter(layout.is_body_block(X.word_count(F.col("text")), F.lit(False), F.col("median_font_size"), F.col("y0"), F.col("height")) & (F.col("median_font_size") <= 12))
    placed = body.join(layout.column_order(body.select("page", "id", "x0", "y0")), ["page", "id"])
    whole = placed.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", X.flatten_lines(F.col("text")).alias("t")))), lambda x: x["t"]), "\n\n").alias("body"))
    long = whole.filter(F.size(F.regexp_extract_all("body", F.lit("[A-Za-z0-9]+"), F.lit(0))) >= least_words).join(issue_of, "page")
    # The last title of an earlier page, carried forward over the issue's pages.
    both = articles.select("issue", "page", "title", F.lit(None).cast("string").alias("body")).unionByName(long.select("issue", "page", F.lit(None).cast("string").alias("title"), "body"))
    by = Window.partitionBy("issue").orderBy("page").rangeBetween(Window.unboundedPreceding, -1)
    carried = both.withColumn("continuation_of", F.last("title", ignorenulls=True).over(by))
    return carried.filter(F.col("body").isNotNull() & (F.coalesce("continuation_of", F.lit("")) != "")).select("issue", "page", F.col("continuation_of").alias("title"), "body", F.lit(True).alias("is_continuation"))


def assemble(requests: DataFrame, blocks: DataFrame) -> DataFrame:
    """(page, article, body, block_ids): blocks in the order asked for; unknown and repeated ids are dropped.

    requests: page, article, block_ids.
    """
    asked = requests.select("page", "article", F.posexplode(F.array_distinct("block_ids")).alias("at", "id"))
    found = asked.join(blocks.select("page", "id", X.flatten_lines(F.col("text")).alias("t")), ["page", "id"])
    sorted_ = F.array_sort(F.collect_list(F.struct("at", "id", "t")))
    return found.groupBy("page", "article").agg(sorted_.alias("p")).select("page", "article", F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("body"), F.transform("p", lambda x: x["id"]).alias("block_ids"))


def merge_groups(articles: DataFrame, groups: DataFrame) -> DataFrame:
    """(page, ordinal, into): rows that proposed groups put together; of overlapping groups the earlier claims a row.

    groups: page, group_no, members (ordinals). Groups need two members that no earlier group has; a
    group's rows go to its first position. Proposals of one page, in order.
    """
    claimed = groups.select("page", "group_no", F.explode(F.array_distinct("members")).alias("ordinal")).join(articles.select("page", "ordinal"), ["page", "ordinal"])
    first = claimed.groupBy("page", "ordinal").agg(F.min("group_no").alias("group_no"))
    of = Window.partitionBy("page", "group_no")
    sized = first.withColumn("n", F.count(F.lit(1)).over(of)).withColumn("into", F.min("ordinal").over(of)).filter("n >= 2")
    return sized.select("page", "ordinal", "into")


def missing_title(figures: Column, page: Column) -> Column:
    """The article of a page that is only pictures."""
    body = F.when(F.size(figures) > 0, F.array_join(F.transform(figures, lambda f: F.concat(F.lit("![]("), f, F.lit(")"))), "\n")).otherwise("")
    return F.struct(F.format_string("Page %d Images", page).alias("title"), body.alias("body"), figures.alias("images"))


# Messages after which no fallback is tried, and marks of a broken file.
FATAL = ("不会退回一页一篇", "视觉 LLM 也未返回文章列表", "无法完成 LLM 文章级拆分")
BROKEN = ("object out of range", "non-page object in page tree", "cannot find object in xref", "expected object number", "xref stream", "repairing pdf", "cannot load object")


def is_fatal(message: Column) -> Column:
    """Errors after which no fallback is tried."""
    return F.exists(F.array(*map(F.lit, FATAL)), lambda m: F.contains(message, m))


def is_broken(message: Column) -> Column:
    """Warnings of a reader that tell of a broken file structure."""
    return F.exists(F.array(*map(F.lit, BROKEN)), lambda m: F.contains(F.lower(message), m))


def cache_valid(version: Column, current: int, error: Column, kind: Column, expected: Column) -> Column:
    """Whether a stored page result can be used again."""
    return F.coalesce(version >= current, F.lit(False)) & error.isNull() & kind.eqNullSafe(expected)
