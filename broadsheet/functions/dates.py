"""Publication type and date from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import label_key

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def publication_type(name: Column) -> Column:
    """Publication of a file name, General if none is named."""
    key = F.concat(F.lit(" "), label_key(name), F.lit(" "))
    return (
        F.when(key.rlike(" barrons? "), "BARRONS")
        .when(F.contains(key, F.lit("wall street journal")) | F.contains(key, F.lit(" wsj ")), "WSJ")
        .when(F.contains(key, F.lit("financial times")) | F.contains(key, F.lit(" ft ")), "FT")
        .when(F.contains(key, F.lit("the economist")) | F.contains(key, F.lit(" economist ")), "TE")
        .otherwise("General")
    )


def month_number(word: Column) -> Column:
    """1 to 12 for an English month or its abbreviation (sept too), else null."""
    out = None
    for i, m in enumerate(MONTHS):
        hit = F.lower(word).isin(m, m[:3], *(["sept"] if m == "september" else []))
        out = F.when(hit, F.lit(i + 1)) if out is None else out.when(hit, F.lit(i + 1))
    return out


def publication_date(name: Column) -> Column:
    """Date in a file name: 20yy-m-d, else Month d, 20yy; null if there is none or it isn't one."""
    iso, spelled = "(20[0-9]{2})[-_]([0-9]{1,2})[-_]([0-9]{1,2})", "([A-Za-z]+)[-_ ]+([0-9]{1,2})[-_, ]+(20[0-9]{2})"
    part = lambda pattern, i: F.regexp_extract(name, pattern, i)
    number = lambda pattern, i: F.lpad(part(pattern, i), 2, "0")
    first = F.concat_ws("-", part(iso, 1), number(iso, 2), number(iso, 3))
    second = F.concat_ws("-", part(spelled, 3), F.lpad(month_number(part(spelled, 1)).cast("string"), 2, "0"), number(spelled, 2))
    return F.when(name.rlike(iso), F.try_to_date(first, "yyyy-MM-dd")).when(name.rlike(spelled) & month_number(part(spelled, 1)).isNotNull(), F.try_to_date(second, "yyyy-MM-dd"))


def display_date(day: Column) -> Column:
    return F.date_format(day, "MMM d, yyyy")
