"""Page geometry: bands, columns, headings, labels and directories.

Blocks have issue, page, ordinal, x0, y0, x1, y1, text and font sizes; pages have width and height.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.functions import vocabulary as V
from broadsheet.functions.geometry import directory_limit, overlap_share


def blocks_of_spans(spans: DataFrame) -> DataFrame:
    """Native text: spans (page, block, line, x0, y0, x1, y1, text, size, bold) to blocks with box, fonts and an id."""
    lines = spans.groupBy("page", "block", "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda s: s["text"]), "").alias("line_text"), *[F.min(c).alias(c) for c in ("x0", "y0")], *[F.max(c).alias(c) for c in ("x1", "y1")], F.collect_list("size").alias("sizes"), F.bool_or("bold").alias("bold"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "line_text"))), lambda x: x["line_text"]), "\n")
    sizes = F.array_sort(F.flatten(F.collect_list("sizes")))
    found = lines.groupBy("page", "block").agg(text.alias("text"), *[F.min(c).alias(c) for c in ("x0", "y0")], *[F.max(c).alias(c) for c in ("x1", "y1")], sizes.alias("s"), F.bool_or("bold").alias("bold"))
    n = F.size("s")
    median = (F.get("s", ((n - 1) / 2).cast("int")) + F.get("s", (n / 2).cast("int"))) / 2
    order = Window.partitionBy("page").orderBy("block")
    return found.select("page", F.format_string("b%03d", F.row_number().over(order)).alias("id"), "x0", "y0", "x1", "y1", "text", F.array_max("s").alias("max_font_size"), F.round(median, 2).alias("median_font_size"), "bold")


def text_quality(text: Column) -> Column:
    """struct(chars, words, alnum_ratio, replacement_ratio, usable) of native text."""
    n = F.greatest(F.length(text), F.lit(1))
    words = F.size(F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")).cast("long")
    alnum = F.length(F.regexp_replace(text, "[^\\p{L}\\p{N}]", ""))
    broken = F.length(F.regexp_replace(text, "[^�]", ""))
    a, b = F.round(alnum / n, 4), F.round(broken / n, 4)
    return F.struct(F.length(text).cast("long").alias("chars"), words.alias("words"), a.alias("alnum_ratio"), b.alias("replacement_ratio"), ((F.length(text) >= 200) & (words >= 40) & (a >= 0.55) & (b <= 0.02)).alias("usable"))


def sample_pages(n_pages: Column, n: int = 3) -> Column:
    """Page numbers (0-based) spread evenly, ends included, halves rounded to even."""
    return F.when(n_pages <= n, F.sequence(F.lit(0).cast("long"), n_pages - 1)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.bround(i * (n_pages - 1) / (n - 1)).cast("long"))))


def page_type(heading: Column, publication: Column) -> Column:
    """contents, utility, politics, business or normal, from the first lines of a heading."""
    keys = F.filter(F.transform(F.split(heading, "\\n"), X.heading_key), lambda k: k != "")
    top, more = F.slice(keys, 1, 6), F.slice(keys, 1, 8)
    joined = F.array_join(top, " ")
    utility = F.exists(more, lambda k: k.isin("index", "data", "winners losers") | k.startswith("data barrons com data"))
    return (
        F.when(F.array_contains(top, "contents"), "contents")
        .when((F.upper(F.trim(F.coalesce(publication, F.lit("")))) == "BARRONS") & utility, "utility")
        .when(F.contains(joined, F.lit("the world this week politics")), "world_this_week_politics")
        .when(F.contains(joined, F.lit("the world this week business")), "world_this_week_business")
        .otherwise("normal")
    )


def header_band(blocks: DataFrame) -> DataFrame:
    """Blocks of the header, with their place in reading order."""
    limit = F.least(F.lit(125.0), F.greatest(0.16 * F.col("height"), F.lit(70.0)))
    order = Window.partitionBy("page").orderBy("y0", "x0", "ordinal")
    return blocks.filter((F.col("y0") <= limit) & (F.col("y1") <= limit + 35)).withColumn("place", F.row_number().over(order).cast("long"))


def at_page_edge(x0: Column, x1: Column, width: Column) -> Column:
    return (x0 <= 0.1 * width) | (x1 >= 0.9 * width)


def is_weekend(publication: Column, header: Column) -> Column:
    """Weekend edition by masthead, or Saturday and Sunday near each other."""
    line = X.squeeze(F.coalesce(header, F.lit("")))
    p = F.upper(F.trim(F.coalesce(publication, F.lit(""))))
    dates = line.rlike("(?i)\\bsaturday\\b(?: ?/ ?sunday\\b|.{0,80}\\bsunday\\b)")
    own = ((p == "FT") & line.rlike("(?i)\\bFT +Weekend\\b")) | ((p == "WSJ") & line.rlike("(?i)\\b(?:The +)?Wall +Street +Journal +Weekend\\b"))
    return p.isin("FT", "WSJ") & (own | dates)


def print_label(line: Column) -> Column:
    """Label such as A12 in a header line: alone, before a bar or section, after a bar, or after the masthead."""
    section = "|".join(s.replace(".", "\\.") for s in V.SECTIONS["WSJ"])
    patterns = ("^([A-Z][0-9]{1,3})$", "^([A-Z][0-9]{1,3}) *\\|", f"^([A-Z][0-9]{{1,3}}) +(?:{section})\\.?$", "\\| *([A-Z][0-9]{1,3}) *$", "^(?:THE +)?WALL +STREET +JOURNAL[.,]? *\\|? *([A-Z][0-9]{1,3})$")
    found = [F.nullif(F.regexp_extract(F.upper(F.trim(line)), p, 1), F.lit("")) for p in patterns]
    return F.coalesce(*found)


def numeric_label(line: Column, masthead: str) -> Column:
    """Page number next to a masthead."""
    before = F.regexp_extract(F.upper(line), f"(?:^| )([0-9]{{1,3}}) +{masthead}\\b", 1)
    after = F.regexp_extract(F.upper(line), f"\\b{masthead} +([0-9]{{1,3}})(?: |$)", 1)
    return F.coalesce(F.nullif(before, F.lit("")), F.nullif(after, F.lit("")))


def is_reference_line(line: Column, before: Column | None = None) -> Column:
    """Lines that send the reader elsewhere, also when the label alone stands on the next line."""
    whole = line.rlike("(?i)\\b(?:continued +(?:on|from)|turn +to|see) +(?:page +)?[A-Z]?[0-9]+\\b")
    if before is None:
        return whole
    opens = X.squeeze(before).rlike("(?i)(?:continued +(?:on|from)|turn +to|see)(?: +page)?$")
    return whole | (F.coalesce(opens, F.lit(False)) & line.rlike("(?i)^[A-Z][0-9]{1,3}$"))


def column_order(blocks: DataFrame, distance: float = V.COLUMN_DISTANCE) -> DataFrame:
    """(page, id, column, place): blocks join the first column whose leader begins within distance, else lead a new one.

    A fold over the page's blocks by x: gaps between neighbours would chain columns that leaders keep
    apart. Columns are read from left to right, blocks downwards.
    """
    listed = blocks.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("x0", "y0", "id"))).alias("b"))
    start = F.struct(F.array().cast("array<double>").alias("leaders"), F.array().cast("array<int>").alias("of"))

    def place(s: Column, b: Column) -> Column:
        near = F.filter(F.sequence(F.lit(1), F.size(s["leaders"]) + 1), lambda i: F.coalesce(F.abs(F.try_element_at(s["leaders"], i) - b["x0"]) <= distance, i > F.size(s["leaders"])))
        at = F.element_at(near, 1)
        leaders = F.when(at > F.size(s["leaders"]), F.array_append(s["leaders"], b["x0"])).otherwise(s["leaders"])
        return F.struct(leaders.alias("leaders"), F.array_append(s["of"], at).alias("of"))

    folded = listed.select("page", F.arrays_zip("b", F.aggregate("b", start, place, lambda s: s["of"]).alias("c")).alias("z"))
    rows = folded.select("page", F.explode("z").alias("z")).select("page", "z.b.id", F.col("z.b.y0").alias("y0"), F.col("z.c").cast("long").alias("column"))
    order = Window.partitionBy("page").orderBy("column", "y0", "id")
    return rows.withColumn("place", F.row_number().over(order).cast("long")).drop("y0")


def quarter_column(x0: Column, width: Column) -> Column:
    """One of four fixed columns, 0 to 3."""
    return F.least(F.floor(F.greatest(x0, F.lit(0.0)) / F.greatest(width / 4, F.lit(1.0))), F.lit(3)).cast("long")


def assign_headings(blocks: DataFrame, headings: DataFrame, reach: float = 900.0, centre: float = 0.18, overlap: float = 60.0, least_overlap: float = 0.12, wide: float = 0.25) -> DataFrame:
    """(page, id, heading, score): each block's heading above it, by least gap, distance of centres and want of overlap.

    A heading counts if its span overlaps the block's by least_overlap of the shorter one, or if it
    is wide and holds the block's centre. A join within a page, whose block count a page bounds.
    """
    h = headings.select("page", F.col("id").alias("heading"), F.col("ordinal").alias("h_ordinal"), *[F.col(c).alias(f"h_{c}") for c in ("x0", "y0", "x1", "y1")])
    both = blocks.join(h, "page")
    gap = F.col("y0") - F.col("h_y1")
    share = overlap_share(F.col("x0"), F.col("x1"), F.col("h_x0"), F.col("h_x1"))
    middle = (F.col("x0") + F.col("x1")) / 2
    holds = (F.col("h_x1") - F.col("h_x0") >= wide * F.col("width")) & middle.between(F.col("h_x0") - 8, F.col("h_x1") + 8)
    apart = F.abs(middle - (F.col("h_x0") + F.col("h_x1")) / 2)
    scored = both.filter((gap >= -2) & (gap <= reach) & ((share >= least_overlap) | holds)).withColumn("score", F.round(gap + centre * apart - overlap * share, 4))
    return scored.groupBy("page", "id").agg(F.min(F.struct("score", "h_ordinal", "heading")).alias("m")).select("page", "id", "m.heading", "m.score")


def nearest_image(headings: DataFrame, images: DataFrame, most: float = 0.45) -> DataFrame:
    """(page, heading, image, distance): the nearest image by the sum of centre distances over the page's size."""
    i = images.select("page", F.col("id").alias("image"), *[F.col(c).alias(f"i_{c}") for c in ("x0", "y0", "x1", "y1")])
    both = headings.join(i, "page")
    d = F.abs((F.col("x0") + F.col("x1") - F.col("i_x0") - F.col("i_x1")) / 2) / F.col("width") + F.abs((F.col("y0") + F.col("y1") - F.col("i_y0") - F.col("i_y1")) / 2) / F.col("height")
    near = both.withColumn("distance", F.round(d, 4)).filter(F.col("distance") < most)
    return near.groupBy("page", F.col("id").alias("heading")).agg(F.min(F.struct("distance", "image")).alias("m")).select("page", "heading", "m.image", "m.distance")


# Headings that are never an article's title.
BLOCKED_HEADINGS = ("what s news", "business finance", "the wall street journal", "corrections amplifications")


def is_heading(text: Column, font: Column, y0: Column, height: Column, threshold: Column) -> Column:
    """Blocks fit for a local title: large, in the body of the page, short, without dotted leaders."""
    flat = X.flatten_lines(text)
    short = X.word_count(flat).between(3, 24) & (F.length(flat) <= 190)
    return (font >= threshold) & (y0 >= 110) & (y0 <= height - 45) & short & ~X.heading_key(flat).isin(*BLOCKED_HEADINGS) & ~flat.rlike("\\.{4,} *[A-Z]?[0-9]+$")


def is_body_block(words: Column, drop_cap: Column, median: Column, y0: Column, height: Column) -> Column:
    """Text of a magazine's article: long, or shorter behind a drop cap, in readable type, below the running head."""
    return ((words >= 35) | (drop_cap & (words >= 20))) & (median >= 7.5) & (y0 >= 0.035 * height)


def in_directory(own_ids: Column, region_ids: Column, share: float = 0.8) -> Column:
    """Whether an article's blocks lie in the directory's region for the most part."""
    return (F.size(own_ids) > 0) & (F.size(F.array_intersect(own_ids, region_ids)) / F.greatest(F.size(own_ids), F.lit(1)) >= share)


BULLET = "^[\ue013•●▪◦]"


def parse_directory(lines: DataFrame) -> DataFrame:
    """Directory of a front page: rows (page, line_no, line) to (page, group_no, group, item_no, text, label).

    Heading, then groups, bullets and wrapped lines; a line that ends in a page label closes its
    item, and a boundary line ends the directory. All by running sums over the page's lines.
    """
    by = Window.partitionBy("page").orderBy("line_no")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    line = X.squeeze(F.col("line"))
    key = F.lower(F.regexp_replace(line, "[’']", ""))
    rows = lines.withColumn("line", line).withColumn("key", key)
    rows = rows.withColumn("three", F.concat_ws(" ", F.lag("key", 2).over(by), F.lag("key", 1).over(by), "key")).withColumn("two", F.concat_ws(" ", F.lag("key", 1).over(by), "key"))
    heading = (F.col("key") == "whats news") | (F.col("two") == "whats news") | (F.col("three") == "what s news")
    rows = rows.withColumn("head", heading.cast("int")).withColumn("open", F.max("head").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.filter("open = 1 and head = 0")
    boundary = F.col("line").rlike("(?i)^(contents|index|markets|opinion|weather|corrections?)$")
    rows = rows.withColumn("stop", F.max(boundary.cast("int")).over(upto)).filter("stop = 0")
    group = F.col("line").rlike("(?i)^(business *& *finance|worldwide)( .*)?$")
    rows = rows.withColumn("is_group", group.cast("int")).withColumn("group_no", F.sum("is_group").over(upto)).filter("group_no > 0")
    inner = Window.partitionBy("page", "group_no").orderBy("line_no")
    rows = rows.withColumn("group", F.first(F.when(F.col("is_group") == 1, F.regexp_extract("line", "(?i)^(business *& *finance|worldwide)", 1)), ignorenulls=True).over(inner.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rows = rows.filter("is_group = 0").withColumn("item_no", F.sum(F.col("line").rlike(BULLET).cast("int")).over(inner)).filter("item_no > 0")
    item = Window.partitionBy("page", "group_no", "item_no").orderBy("line_no")
    closed = F.max(F.col("line").rlike("[ ,.;:][A-Z][0-9]{1,3}\\.?$").cast("int")).over(item.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("closed", F.coalesce(closed, F.lit(0))).filter("closed = 0")
    joined = rows.groupBy("page", "group_no", "group", "item_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), " ").alias("raw"))
    bare = F.regexp_replace("raw", BULLET, "")
    pattern = "^(.*?)[,.;:]? +([A-Za-z][0-9]{1,3})\\.?$"
    text = F.regexp_replace(F.regexp_extract(bare, pattern, 1), "^[ –—-]+|[ –—-]+$", "")
    out = joined.select("page", "group_no", "group", "item_no", text.alias("text"), F.upper(F.regexp_extract(bare, pattern, 2)).alias("label"))
    return out.filter("label <> '' and text <> ''")


def parse_briefing(lines: DataFrame) -> DataFrame:
    """Briefing of a front page: rows (page, line_no, line) to (page, item_no, text, label).

    Starts after a line Briefing and ends at a boundary, which may be the beginning of a line; items
    open with an arrow; the page is named anywhere in an item, or nowhere.
    """
    by = Window.partitionBy("page").orderBy("line_no")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("line", X.squeeze(F.col("line"))).filter("line <> ''")
    rows = rows.withColumn("open", F.max(F.col("line").rlike("(?i)^briefing$").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1))).filter("open = 1")
    rows = rows.withColumn("stop", F.max(F.col("line").rlike("(?i)^(world markets|subscribe|for the latest news|contents|index)\\b").cast("int")).over(upto)).filter("stop = 0")
    arrow = "^[^A-Za-z]{0,4}[>»•▶▸►] *"
    rows = rows.withColumn("item_no", F.sum(F.col("line").rlike(arrow).cast("int")).over(upto)).filter("item_no > 0")
    joined = rows.groupBy("page", "item_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", F.regexp_replace("line", arrow, "").alias("line")))), lambda x: x["line"]), " ").alias("text"))
    text = F.regexp_replace(X.squeeze(F.col("text")), "^[ –—-]+|[ –—-]+$", "")
    return joined.select("page", "item_no", text.alias("text"), F.nullif(F.regexp_extract("text", "(?i)\\bpage *([0-9]{1,3})\\b", 1), F.lit("")).alias("label")).filter("text <> ''")


def directory_region(blocks: DataFrame) -> DataFrame:
    """Blocks of the left-hand news directory, with their place: under its heading, left of the next column.

    The heading is the top-most block that names the directory in the left of the page; a block that
    holds a group's name may be wider; the first block that opens with a boundary ends the region.
    """
    page = Window.partitionBy("page")
    named = F.lower(F.regexp_replace("text", "[’']", "")).rlike("what *s[ \\t-\\r]+news|whats[ \\t-\\r]+news") & (F.col("x0") <= 0.36 * F.col("width"))
    head = F.min(F.when(named, F.struct("y0", "x0", "x1", "ordinal"))).over(page)
    rows = blocks.withColumn("head", head).filter("head is not null")
    right = (F.col("x0") > F.col("head.x1") + F.greatest(F.lit(6.0), 0.01 * F.col("width"))) & (F.col("y1") >= F.col("head.y0") - 4)
    rows = rows.withColumn("next_x", F.coalesce(F.min(F.when(right, F.col("x0"))).over(page), F.col("head.x1") + 0.04 * F.col("width")))
    limit = directory_limit(F.col("width"), F.col("head.x1"), F.col("next_x"))
    own = F.col("ordinal") == F.col("head.ordinal")
    group = F.col("text").rlike("(?im)^[ \\t]*(business[ \\t-\\r]*&[ \\t-\\r]*finance|worldwide)[ \\t]*$")
    inside = (F.col("y1") >= F.col("head.y0") - 4) & (F.col("y0") <= 0.98 * F.col("height")) & (F.col("x0") <= limit) & ((F.col("x1") <= limit + 0.03 * F.col("width")) | own | group)
    order = Window.partitionBy("page").orderBy(F.when(own, 0).otherwise(1), F.greatest("y0", "head.y0"), "x0", "ordinal")
    kept = rows.filter(inside).withColumn("place", F.row_number().over(order).cast("long"))
    return _until_boundary(kept, "(?i)^(contents|index|markets|opinion|weather|corrections?)\\b").select("page", "id", "place")


def briefing_region(blocks: DataFrame) -> DataFrame:
    """Blocks of the right-hand briefing rail, with their place."""
    page = Window.partitionBy("page")
    named = F.col("text").rlike("(?im)^[ \\t]*briefing[ \\t]*$") & (F.col("x0") >= 0.65 * F.col("width")) & (F.col("y0") <= 0.4 * F.col("height"))
    rows = blocks.withColumn("head", F.min(F.when(named, F.struct("y0", "x0"))).over(page)).filter("head is not null")
    left = F.greatest(0.72 * F.col("width"), F.col("head.x0") - 0.03 * F.col("width"))
    inside = (F.col("x0") >= left) & (F.col("y0") >= F.col("head.y0") - 4) & (F.col("y1") <= 0.78 * F.col("height"))
    kept = rows.filter(inside).withColumn("place", F.row_number().over(Window.partitionBy("page").orderBy("y0", "x0", "ordinal")).cast("long"))
    return _until_boundary(kept, "(?i)^(world markets|subscribe|for the latest news|contents|index)\\b").select("page", "id", "place")


def _until_boundary(placed: DataFrame, pattern: str) -> DataFrame:
    """Rows of a page before the first, other than the very first, whose opening line matches."""
    opening = X.squeeze(F.substring_index(X.strip(F.col("text")), "\n", 1))
    hit = ((F.col("place") > 1) & opening.rlike(pattern)).cast("int")
    by = Window.partitionBy("page").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("_stop", F.max(hit).over(by)).filter("_stop = 0").drop("_stop")


def front_page(pages: DataFrame) -> DataFrame:
    """The first page of each issue with the label that its publication gives its front page and with directory groups."""
    expected = F.when(F.col("publication_type") == "WSJ", "A1").when(F.col("publication_type") == "FT", "1")
    hit = (F.col("print_page_label") == expected) & (F.col("n_groups") > 0)
    return pages.filter(hit).groupBy("issue").agg(F.min("pdf_page").alias("pdf_page"))


def enrich_layout(old: Column, new: Column, attempted: Column, mode: str) -> Column:
    """A stored layout value after extraction: replace sets what was found, null too; merge only what isn't null."""
    if mode == "replace":
        return F.when(attempted, new).otherwise(old)
    return F.when(attempted, F.coalesce(new, old)).otherwise(old)
