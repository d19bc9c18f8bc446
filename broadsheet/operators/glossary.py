"""Glossary: entries, annotations and their places in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.text import clean_inline, slug

# Words too general to be terms, and the kinds of terms.
GENERIC = (
    "business", "ceo", "company", "democracy", "economy", "government",
    "globalization", "inflation", "market", "president", "sovereignty", "us", "uk",
)
KINDS = ("person", "organization", "company", "policy_law", "event", "place_context", "work", "proper_concept", "acronym")


def entry_id(kind: Column, term: Column) -> Column:
    return F.concat_ws("_", kind, slug(term, "term", 80))


def is_proper_term(term: Column, kind: Column | None = None) -> Column:
    """Names and acronyms: two characters, a letter, not general, not one word of small letters; a capital, digit or dot is needed."""
    t = clean_inline(term)
    rejected = (F.length(t) < 2) | F.lower(t).isin(*GENERIC) | ~t.rlike("[A-Za-z]")
    acronym = (kind == "acronym") if kind is not None else F.lit(False)
    return F.when(rejected, False).when(acronym, t.rlike("^[A-Z][A-Z0-9.-]{1,11}$")).when(t.rlike("^[a-z][a-z-]*$"), False).otherwise(t.rlike("[A-Z0-9.]"))


def referenced(entries: DataFrame, annotations: DataFrame) -> DataFrame:
    """Entries that annotations refer to; of rows with one id the last wins."""
    last = entries.groupBy("glossary_id").agg(*[F.max_by(c, "seq").alias(c) for c in entries.columns if c not in ("glossary_id", "seq")])
    return last.join(annotations.select("glossary_id").distinct(), "glossary_id", "left_semi")


def distinct_places(annotations: DataFrame, most: int = 2) -> DataFrame:
    """Annotations once for each place, and at most ``most`` for a term of an article, in order."""
    place = Window.partitionBy("article", "paragraph", "surface", "occurrence").orderBy("seq")
    first = annotations.withColumn("_r", F.row_number().over(place)).filter("_r = 1").drop("_r")
    term = Window.partitionBy("article", "glossary_id").orderBy("seq")
    return first.withColumn("_r", F.row_number().over(term)).filter(F.col("_r") <= most).drop("_r")


def locate(paragraphs: DataFrame, terms: DataFrame) -> DataFrame:
    """Every place of every term of an article: (article, paragraph, glossary_id, surface, occurrence).

    terms: article, glossary_id, term. Case aside, between borders of letters and digits; term may hold anything.
    """
    quoted = F.regexp_replace("term", "([^A-Za-z0-9 ])", "\\\\$1")
    pattern = "concat('(?i)(?<![A-Za-z0-9])(', _q, ')(?![A-Za-z0-9])')"
    both = paragraphs.join(terms.withColumn("_q", quoted), "article").withColumn("hits", F.expr(f"regexp_extract_all(text, {pattern}, 1)"))
    return both.select("article", "paragraph", "glossary_id", F.posexplode("hits").alias("n", "surface")).withColumn("occurrence", (F.col("n") + 1).cast("long")).drop("n")


def prompt_text(paragraphs: DataFrame, most: int = 24_000) -> DataFrame:
    """(article, text): numbered paragraphs in order, up to a budget of characters; the last is cut at a space.

    paragraphs: article, paragraph, text. By running sums.
    """
    line = F.concat(F.lit("["), F.col("paragraph"), F.lit("] "), F.col("text"))
    by = Window.partitionBy("article").orderBy("paragraph")
    sized = paragraphs.withColumn("line", line).withColumn("before", F.coalesce(F.sum(F.length("line") + 1).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).filter(F.col("before") < most)
    room = (F.lit(most) - F.col("before")).cast("int")
    cut = F.regexp_replace(F.left("line", room), " [^ ]*$", "")
    parts = sized.withColumn("line", F.when(F.length("line") <= room, F.col("line")).otherwise(cut))
    return parts.groupBy("article").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("paragraph", "line"))), lambda x: x["line"]), "\n").alias("text"))


def normalise_reply(reply: Column) -> Column:
    """Entries of a model's reply, by whatever name it calls the list and the term."""
    kind = "array<struct<term string, canonical_term string, name string, term_zh string, type string, description_zh string>>"
    lists = [F.from_json(F.get_json_object(reply, f"$.{k}"), kind) for k in ("terms", "glossary", "items")]
    found = F.coalesce(*lists, F.array().cast(kind))
    return F.transform(found, lambda e: F.struct(F.coalesce(e["term"], e["canonical_term"], e["name"]).alias("term"), e["term_zh"].alias("term_zh"), F.when(e["type"].isin(*KINDS), e["type"]).otherwise("proper_concept").alias("type"), e["description_zh"].alias("description_zh")))
