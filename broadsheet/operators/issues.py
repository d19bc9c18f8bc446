"""Issues: identities, payloads, the index and the ledger of processed inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.text import slug


def issue_id(kind: Column, day: Column, stem: Column) -> Column:
    text = F.date_format(day, "yyyy-MM-dd")
    return F.when(kind == "BARRONS", F.concat(F.lit("BARRONS_"), text, F.lit("_barrons-weekly"))).otherwise(F.concat_ws("_", kind, text, slug(stem, "paper")))


def article_id(issue: Column, kind: Column, day: Column, page: Column, on_page: Column, index: Column) -> Column:
    """Serial within the issue for weekly magazines, page and place for the others."""
    return F.when(kind == "BARRONS", F.concat(F.lit("art_"), F.date_format(day, "yyyy-MM-dd"), F.format_string("_%03d", index))).otherwise(F.concat(issue, F.format_string("_p%02d_%02d", page, on_page)))


def fingerprint_key(kind: Column, day: Column, name: Column) -> Column:
    return F.concat_ws("|", F.upper(kind), F.date_format(day, "yyyy-MM-dd"), F.lower(name))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; order must tell all rows of a key apart."""
    by = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return rows.withColumn("_r", F.row_number().over(by)).filter("_r = 1").drop("_r")


def index_upsert(index: DataFrame, new: DataFrame) -> DataFrame:
    """index with the rows of new in place of those with their ids, in order of date, type and file name."""
    kept = index.join(new.select("id"), "id", "left_anti")
    return kept.unionByName(new).orderBy("publication_date", "publication_type", "original_filename")


def ledger_upsert(ledger: DataFrame, new: DataFrame, key: str = "fingerprint_key", fixed: tuple[str, ...] = ("filename", "publication_type", "publication_date")) -> DataFrame:
    """Insert or update by key: what is in ``fixed`` stays as first written, the rest is replaced.

    Rows of new are applied in the order of processed_at, sha256.
    """
    both = ledger.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    order = F.struct("_new", "processed_at", "sha256")
    aggregates = [(F.min_by if c in fixed else F.max_by)(c, order).alias(c) for c in ledger.columns if c != key]
    return both.groupBy(key).agg(*aggregates).select(*ledger.columns)


def ledger_reconcile(ledger: DataFrame, index: DataFrame, path: str = "output_path", index_path: str = "database_path") -> DataFrame:
    """Ledger rows whose output the index lists; all of them while the index is empty."""
    if index.isEmpty():
        return ledger
    return ledger.join(index.select(F.col(index_path).alias(path)).distinct(), path, "left_semi")


def already_processed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files known by content or by key: two equi semi-joins, never an OR join."""
    by_hash = files.join(ledger.select("sha256"), "sha256", "left_semi")
    by_key = files.join(ledger.select("sha256").distinct(), "sha256", "left_anti").join(ledger.select("fingerprint_key"), "fingerprint_key", "left_semi")
    return by_hash.unionByName(by_key.select(*files.columns))


def carry_forward(current: DataFrame, previous: DataFrame, key: str, columns: list[str], fresh: Column) -> DataFrame:
    """current with columns of the previous row of its key where its own aren't fresh."""
    old = previous.select(key, F.lit(True).alias("_had"), *[F.col(c).alias(f"_old_{c}") for c in columns])
    joined = current.join(old, key, "left")
    keep = ~fresh & F.coalesce("_had", F.lit(False))
    return joined.select(*[F.when(keep, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in current.columns])


def write_action(stored: Column, action: Column, value: Column) -> Column:
    """Three-state argument: keep the stored value, clear it, or replace it."""
    return F.when(action == "keep", stored).when(action == "replace", value)


def last_wins(entries: DataFrame, key: str, order: str) -> DataFrame:
    return entries.groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in entries.columns if c != key])


def missing_pages(issues: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(issue, page) that is expected (page_count) and has no valid checkpoint row."""
    expected = issues.filter("page_count > 0").select("issue", F.explode(F.sequence(F.lit(1).cast("long"), F.col("page_count"))).alias("page"))
    return expected.join(checkpoints.select("issue", "page"), ["issue", "page"], "left_anti")


def completeness(issues: DataFrame, missing: DataFrame, most: int = 8) -> DataFrame:
    """issues with missing page count, the first few missing pages and whether all are there."""
    found = missing.groupBy("issue").agg(F.count(F.lit(1)).alias("n_missing"), F.slice(F.array_sort(F.collect_list("page")), 1, most).alias("first_missing"))
    return issues.join(found, "issue", "left").select("issue", "page_count", F.coalesce("n_missing", F.lit(0)).alias("n_missing"), F.coalesce("first_missing", F.array().cast("array<long>")).alias("first_missing"), F.col("n_missing").isNull().alias("complete"))


def index_union(primary: DataFrame, external: DataFrame, kind: str = "TE") -> DataFrame:
    """Primary rows but for one kind, then that kind from the external index if it has any, else from the primary; last wins by id."""
    has = not external.filter(F.col("publication_type") == kind).isEmpty()
    own = primary.withColumn("database_root", F.lit("primary"))
    other = external.filter(F.col("publication_type") == kind).withColumn("database_root", F.lit("external"))
    both = own.filter(F.col("publication_type") != kind).unionByName(other) if has else own
    return both


def page_fields(rows: DataFrame) -> DataFrame:
    """Issue pages in order: page_order ranks all pages before those without a number go."""
    by = Window.partitionBy("issue").orderBy("pdf_page")
    return rows.withColumn("page_order", F.row_number().over(by).cast("long")).filter("pdf_page > 0")


def unique_names(rows: DataFrame, group: list[str], base: str, order: str, alias: str = "name") -> DataFrame:
    """rows with name: base, then base_2, base_3 and so on in order; a suffix never takes another row's base."""
    by = Window.partitionBy(*group, base).orderBy(order)
    numbered = rows.withColumn("_n", F.row_number().over(by))
    first = numbered.withColumn(alias, F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("_"), F.col("_n").cast("string"))))
    taken = rows.select(*group, F.col(base).alias("_b")).distinct()
    clash = first.join(taken, [*[first[g] == taken[g] for g in group], first[alias] == taken["_b"], F.col("_n") > 1], "left").select(*[first[c] for c in first.columns], F.col("_b"))
    return clash.withColumn(alias, F.when(F.col("_b").isNotNull(), F.concat(F.col(alias), F.lit("_x"), F.col("_n").cast("string"))).otherwise(F.col(alias))).drop("_n", "_b")


def rename_assets(text: Column, names: Column) -> Column:
    """Text with each old name of a map replaced by its new one, longest first so that no name eats another's end."""
    entries = F.array_sort(F.map_entries(names), lambda a, b: F.length(b["key"]) - F.length(a["key"]))
    return F.aggregate(entries, text, lambda t, e: F.replace(t, e["key"], e["value"]))


def rename_list(images: Column, names: Column) -> Column:
    return F.transform(images, lambda x: F.coalesce(F.try_element_at(names, x), x))


def weekend_issues(pages: DataFrame) -> DataFrame:
    """(issue, weekend): whether page 1 of an issue is a weekend's."""
    return pages.groupBy("issue").agg(F.coalesce(F.bool_or((F.col("page") == 1) & F.coalesce("is_weekend", F.lit(False))), F.lit(False)).alias("weekend"))


def pages_to_retry(failed: DataFrame, pending: DataFrame) -> DataFrame:
    """(issue, pages): numbers of pages that failed or wait for a compilation, each once, in order; those without a number don't count."""
    both = failed.select("issue", "page").unionByName(pending.select("issue", "page")).filter("page > 0")
    return both.groupBy("issue").agg(F.array_sort(F.collect_set("page")).alias("pages"))


def work_order(pages: DataFrame, cached: DataFrame) -> DataFrame:
    """pages (issue, page) with cached and place: those without a stored result first, then by number."""
    marked = pages.join(cached.select("issue", "page").distinct().withColumn("_c", F.lit(True)), ["issue", "page"], "left").withColumn("cached", F.coalesce("_c", F.lit(False))).drop("_c")
    return marked.withColumn("place", F.row_number().over(Window.partitionBy("issue").orderBy("cached", "page")).cast("long"))


def sources_union(*sources: DataFrame, day: str = "publication_date", kind: str = "publication_type", path: str = "database_path") -> DataFrame:
    """Rows of all index sources, the last source's of each key: the id, or type, day and path where it has none."""
    key = F.coalesce(F.nullif(F.trim(F.coalesce("id", F.lit(""))), F.lit("")), F.concat_ws("|", kind, day, path))
    both = sources[0].withColumn("_at", F.lit(0))
    for n, s in enumerate(sources[1:], 1):
        both = both.unionByName(s.withColumn("_at", F.lit(n)))
    rows = both.withColumn("_key", key).select("_key", "_at", F.struct(*sources[0].columns).alias("_row"))
    return rows.groupBy("_key").agg(F.max_by("_row", "_at").alias("_row")).select("_row.*")


def without_id(entry: Column, publication: Column) -> Column:
    """A glossary entry as an issue stores it: without its id but in the one publication whose readers look it up."""
    return F.when(F.upper(publication) == "BARRONS", F.to_json(entry)).otherwise(F.to_json(entry.dropFields("id")))


def issue_rows(spark, path: str, issue: str) -> DataFrame:
    """The rows of one issue of a table partitioned by issue: other issues' files are not listed."""
    return spark.read.parquet(path).filter(F.col("issue") == issue)


def status_report(ledger: DataFrame, most: int = 20) -> DataFrame:
    """The latest entries of the ledger, newest first."""
    return ledger.orderBy(F.col("processed_at").desc(), "fingerprint_key").limit(most)


def whole_issues(issues: DataFrame, failed: DataFrame, pending: DataFrame, checkpoints: DataFrame, most: int = 8) -> DataFrame:
    """(issue, complete, reason, pages): whether an issue has no failed, no pending and no missing page, else the first reason and the first few of its pages.

    issues: issue, page_count; the others: issue, page.
    """
    of = lambda df, n, why: df.select("issue", F.col("page").cast("long").alias("page"), F.lit(n).alias("n"), F.lit(why).alias("why"))
    bad = of(failed, 1, "failed").unionByName(of(pending, 2, "pending")).unionByName(of(missing_pages(issues, checkpoints), 3, "missing"))
    per = bad.groupBy("issue", "n", "why").agg(F.slice(F.array_sort(F.collect_set("page")), 1, most).alias("pages"))
    first = per.groupBy("issue").agg(F.min(F.struct("n", "why", "pages")).alias("b"))
    joined = issues.select("issue").distinct().join(first, "issue", "left")
    return joined.select("issue", F.col("b").isNull().alias("complete"), F.col("b.why").alias("reason"), F.coalesce("b.pages", F.array().cast("array<long>")).alias("pages"))


def image_paths(ids: Column, paths: Column) -> Column:
    """Paths of images by id from a map; what is a path below images/ already stays. Each once, in order; unknown ids go."""
    found = F.transform(ids, lambda x: F.coalesce(F.try_element_at(paths, x), F.when(x.startswith("images/"), x)))
    return F.array_distinct(F.filter(found, lambda p: p.isNotNull()))


def ledger_of(ledger: DataFrame, sha256: str | None = None, key: str | None = None) -> DataFrame:
    """Ledger rows, newest first: all, or those of a content or of a key."""
    known = ledger if sha256 is None else ledger.filter(F.col("sha256") == sha256)
    known = known if key is None else known.filter(F.col("fingerprint_key") == key)
    return known.orderBy(F.col("processed_at").desc(), "fingerprint_key")
