"""Links between directory items, articles and pages."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.functions import vocabulary as V


def directory_links(items: DataFrame, articles: DataFrame, threshold: int = V.LINK_THRESHOLD_UNLABELLED, least_title: int = 2) -> DataFrame:
    """Best article for each item (item_id, text) among articles (ordinal, title, body): score 7 a title token and 1 a body token.

    Candidates share at least least_title title tokens with the item and come from an inverted index
    of title tokens, so no pair is met without a shared token; body tokens are looked up only for
    candidates. Ties go to the smaller ordinal.
    """
    query = items.select("item_id", X.link_tokens(F.col("text")).alias("tokens"))
    wanted = query.select("item_id", F.explode("tokens").alias("token"))
    titles = articles.select("ordinal", F.explode(X.link_tokens(F.col("title"))).alias("token"))
    pairs = wanted.join(titles, "token").groupBy("item_id", "ordinal").agg(F.count(F.lit(1)).alias("title_hits")).filter(F.col("title_hits") >= least_title)
    bodies = articles.select("ordinal", X.link_tokens(F.col("body")).alias("body_tokens"))
    scored = pairs.join(bodies, "ordinal").join(query, "item_id").withColumn("score", F.lit(V.LINK_TITLE_WEIGHT) * F.col("title_hits") + F.size(F.array_intersect("tokens", "body_tokens")))
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "ordinal")
    top = scored.filter(F.col("score") >= threshold).withColumn("_r", F.row_number().over(best)).filter("_r = 1")
    return top.select("item_id", "ordinal", F.col("score").cast("long").alias("score"))


def unique_directory_links(items: DataFrame, articles: DataFrame) -> DataFrame:
    """One-to-one links of one issue's directory: items in order, each takes the best article still free.

    items: issue, item_id, text, label, explicit; articles: issue, ordinal, title, body, label. An
    explicit valid link wins even if used. A single candidate needs no score. An issue is one group,
    bounded by the length of its directory and of its list of articles.
    """
    import pandas as pd

    tokens = articles.select("issue", "ordinal", F.upper(F.trim(F.coalesce("label", F.lit("")))).alias("label"), X.link_tokens(F.col("title")).alias("title"), X.link_tokens(F.col("body")).alias("body"))
    wanted = items.select("issue", "item_id", F.upper(F.trim(F.coalesce("label", F.lit("")))).alias("label"), "explicit", X.link_tokens(F.col("text")).alias("tokens"))

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = [(r.ordinal, r.label, set(r.title), set(r.body)) for r in right.sort_values("ordinal").itertuples()]
        known, used, out = {r[0] for r in rows}, set(), []
        for item in left.sort_values("item_id").itertuples():
            chosen = None
            if not pd.isna(item.explicit) and item.explicit in known:
                chosen = item.explicit
            else:
                query = set(item.tokens)
                free = [r for r in rows if r[0] not in used and (r[1] == item.label if item.label else len(query & r[2]) >= 2)]
                if len(free) == 1:
                    chosen = free[0][0]
                elif free:
                    points = [0 if not (t := len(query & r[2])) and (b := len(query & r[3])) < 3 else V.LINK_TITLE_WEIGHT * t + len(query & r[3]) for r in free]
                    best = max(range(len(free)), key=lambda i: (points[i], -i))
                    if points[best] >= (V.LINK_THRESHOLD_LABELLED if item.label else V.LINK_THRESHOLD_UNLABELLED):
                        chosen = free[best][0]
            if chosen is not None:
                used.add(chosen)
                out.append((item.issue, item.item_id, int(chosen)))
        return pd.DataFrame(out, columns=["issue", "item_id", "ordinal"])

    kind = wanted.schema["issue"].dataType.simpleString()
    return wanted.groupBy("issue").cogroup(tokens.groupBy("issue")).applyInPandas(solve, f"issue {kind}, item_id long, ordinal long")


#: Rows of (item, token, count) up to which a directory goes to each task whole; four times as many tokens.
DIRECTORY_ROWS = 500_000


def outside_directory(articles: DataFrame, items: DataFrame, coverage: float = V.DIRECTORY_COVERAGE, item_share: float = V.DIRECTORY_ITEM, least: int = V.DIRECTORY_TOKENS) -> DataFrame:
    """Articles without those that mostly repeat the directory: bag coverage of the text and of its best item.

    articles: ordinal, body; items: item_id, text. The directory goes to the tasks as an index of its
    tokens, so an article is decided where it is read: a task holds one article's counts, and of the articles only
    ordinals move. A directory beyond DIRECTORY_ROWS, or rows that share an ordinal and count as one
    text, go by joins on tokens and sums of the lesser count. Directory and ordinals are looked at when the plan is made.
    """
    item_bags = items.select("item_id", X.summary_tokens(F.col("text")).alias("t")).filter(F.size("t") >= least)
    item_counts = item_bags.select("item_id", F.size("t").alias("item_n"), F.explode("t").alias("token")).groupBy("item_id", "item_n", "token").agg(F.count(F.lit(1)).alias("c"))
    index = _directory_index(item_counts.limit(DIRECTORY_ROWS + 1).toArrow(), item_share)
    if index is None or not articles.groupBy("ordinal").count().filter("count > 1").isEmpty():
        drop = _in_directory_by_joins(articles, item_counts, coverage, item_share, least)
    else:
        drop = _in_directory(articles, index, coverage, least)
    return articles.join(drop.distinct(), "ordinal", "left_anti")


def _directory_index(counts: pa.Table, item_share: float) -> tuple[dict, list[int]] | None:
    """({token: (copies in the directory, [items with a first copy, items with a second, ...])}, copies that each item needs); None if that is too large."""
    rows = counts.to_pydict()
    if counts.num_rows > DIRECTORY_ROWS or sum(rows["c"]) > 4 * DIRECTORY_ROWS:
        return None
    numbers: dict[tuple, int] = {}
    index: dict[str, tuple[int, list[list[int]]]] = {}
    for item, n, token, c in zip(rows["item_id"], rows["item_n"], rows["token"], rows["c"], strict=True):
        number = numbers.setdefault((item, n), len(numbers))
        copies, having = index.get(token, (0, []))
        having.extend([] for _ in range(c - len(having)))
        for k in range(c):
            having[k].append(number)
        index[token] = copies + c, having
    # The same quotient as in a join, so the same rounding.
    return index, [next((h for h in range(n + 1) if h / n >= item_share), n + 1) for _, n in numbers]


def _in_directory(articles: DataFrame, index: tuple[dict, list[int]], coverage: float, least: int) -> DataFrame:
    shared = articles.sparkSession.sparkContext.broadcast(index)
    token = re.compile(X.SUMMARY_TOKEN)

    def repeats(text: str | None) -> bool:
        found = token.findall(text or "")
        if len(found) < max(least, 1):
            return False
        index, needed = shared.value
        own = [(c, index[t]) for t, c in Counter(found).items() if t in index]
        # An item's n-th copy of a token is met by the article's n-th.
        if not sum(min(c, copies) for c, (copies, _) in own) / len(found) >= coverage:
            return False
        hits = Counter(chain.from_iterable(chain.from_iterable(having[:c] for c, (_, having) in own)))
        return any(h >= needed[item] for item, h in hits.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.record_batch([part.column(0).filter(pa.array([repeats(t.as_py()) for t in part.column(1)], pa.bool_()))], names=["ordinal"])

    texts = articles.select("ordinal", X.summary_text(F.col("body")).alias("text"))
    return texts.mapInArrow(run, texts.select("ordinal").schema)


def _in_directory_by_joins(articles: DataFrame, item_counts: DataFrame, coverage: float, item_share: float, least: int) -> DataFrame:
    directory = item_counts.groupBy("token").agg(F.sum("c").alias("c_dir"))
    bags = articles.select("ordinal", X.summary_tokens(F.col("body")).alias("t")).filter(F.size("t") >= least)
    # Tokens that no item has go before anything is counted or moved.
    tokens = bags.select("ordinal", F.size("t").alias("n"), F.explode("t").alias("token")).join(directory.select("token"), "token", "left_semi")
    counts = tokens.groupBy("ordinal", "n", "token").agg(F.count(F.lit(1)).alias("c_own"))
    covered = counts.join(directory, "token").groupBy("ordinal", "n").agg(F.sum(F.least("c_own", "c_dir")).alias("hit")).filter(F.col("hit") / F.col("n") >= coverage)
    # Only articles that the directory covers are compared with its items.
    shared = counts.join(covered.select("ordinal"), "ordinal", "left_semi").join(item_counts, "token").groupBy("ordinal", "item_id", "item_n").agg(F.sum(F.least("c_own", "c")).alias("hit"))
    return shared.filter(F.col("hit") / F.col("item_n") >= item_share).select("ordinal")


def without_module_lines(lines: DataFrame, module: DataFrame) -> DataFrame:
    """Lines of a page (page, line_no, line) without those of a module (page, line), each as often as the module has it.

    Exact part of the bag difference: the n-th copy of a line goes with the n-th copy in the module.
    """
    order = Window.partitionBy("page", "line").orderBy("line_no")
    numbered = lines.withColumn("_n", F.row_number().over(order))
    drop = module.groupBy("page", "line").agg(F.count(F.lit(1)).alias("_c"))
    joined = numbered.join(drop, ["page", "line"], "left")
    return joined.filter(F.col("_c").isNull() | (F.col("_n") > F.col("_c"))).select(*lines.columns)


def page_membership(pages: DataFrame, articles: DataFrame) -> DataFrame:
    """Pages (issue, pdf_page) with the ordered ids of articles (issue, id, ordinal, page, source_pages) printed on them."""
    on = F.when(F.size(F.coalesce("source_pages", F.array().cast("array<long>"))) > 0, F.array_distinct("source_pages")).otherwise(F.array(F.col("page")))
    spread = articles.select("issue", F.explode(on).alias("pdf_page"), F.struct("ordinal", "id").alias("a"))
    found = spread.groupBy("issue", "pdf_page").agg(F.transform(F.array_sort(F.collect_list("a")), lambda x: x["id"]).alias("article_ids"))
    return pages.join(found, ["issue", "pdf_page"], "left").withColumn("article_ids", F.coalesce("article_ids", F.array().cast("array<string>")))


def lookup_category(rows: DataFrame, dimension: DataFrame, key: str = "category") -> DataFrame:
    """rows with name and how: from the dimension (category, name, position) by exact match, else by the first one alike but for case."""
    exact = dimension.groupBy("category").agg(F.min_by("name", "position").alias("_exact"))
    loose = dimension.groupBy(F.upper("category").alias("_u")).agg(F.min_by("name", "position").alias("_loose"))
    joined = rows.join(exact, rows[key] == exact["category"], "left").drop(exact["category"]).join(loose, F.upper(rows[key]) == F.col("_u"), "left")
    how = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_loose").isNotNull(), "case").otherwise("none")
    return joined.select(*[rows[c] for c in rows.columns], F.coalesce("_exact", "_loose").alias("name"), how.alias("how"))


def standard_category(category, standards=V.STANDARD_CATEGORIES):
    """The standard category that a category equals but for case, or begins with before a slash or a spaced dash; else itself.

    One CASE generated from the ordered list: no join. The names compared are worked out once, as a
    lambda's argument; as one JVM method the arms would be too long to be compiled.
    """

    def chosen(c: Column) -> Column:
        upper, out = c["upper"], F.when(F.coalesce(c["own"], F.lit("")) == "", F.lit("General"))
        for s in standards:
            out = out.when(upper == s.upper(), F.lit(s))
        for s in standards:
            u = s.upper()
            slash = upper.startswith(u + " /") | upper.startswith(u + "/")
            dashes = (c["dash"] & upper.startswith(u + " -")) | (c["long_dash"] & upper.startswith(u + " —"))
            out = out.when(slash | dashes, F.lit(s))
        return out.otherwise(c["own"])

    own, upper = F.trim(category), F.upper(F.trim(category))
    names = F.struct(own.alias("own"), upper.alias("upper"), F.contains(upper, F.lit(" - ")).alias("dash"), F.contains(upper, F.lit(" — ")).alias("long_dash"))
    return X.once(names, chosen)
