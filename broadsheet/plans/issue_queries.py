"""Queries that merge, link and keep issues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.operators import articles as A
from broadsheet.operators import folds, fuzzy, glossary, issues, linking
from broadsheet.plans.registry import Registry, table
from broadsheet.plans.text_queries import ARTICLES, KEY, articles
from broadsheet.sources import exports

register = Registry()

TOKENS = "regexp_extract_all(lower({0}), '[a-z0-9]+')"
#: A fold that leaves out bodies that are there already; titles are alike within a group.
FOLD = f"""list_reduce(bodies, lambda s, b: CASE WHEN s = '' THEN b WHEN b = '' OR (CASE WHEN len({TOKENS.format("b")}) = 0 THEN 0.0 ELSE len(list_filter({TOKENS.format("b")}, lambda t: list_contains({TOKENS.format("s")}, t))) / len({TOKENS.format("b")}) END) >= {{0}} THEN s ELSE s || chr(10) || chr(10) || b END)"""


@register(rf"""WITH {ARTICLES}, k AS (SELECT *, CASE WHEN {KEY.format("title")} = '' THEN chr(1) || ordinal ELSE {KEY.format("title")} END AS key FROM a),
g AS (SELECT issue, page, key, list(body ORDER BY ordinal) AS bodies, min(ordinal) AS ordinal, arg_min(title, ordinal) AS title, string_agg(ordinal, ',' ORDER BY ordinal) AS members FROM k GROUP BY ALL)
SELECT issue, page, ordinal, title, {FOLD.format(0.65)} AS body, members FROM g""")
def cross_copy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.merge_same_titles(articles(spark, sf_dir)).withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@register(rf"""WITH {ARTICLES}, k AS (SELECT *, {KEY.format("title")} AS key FROM a),
g AS (SELECT issue, key, list(body ORDER BY page, ordinal) AS bodies, min(ordinal) AS ordinal, min(page) AS page, string_agg(DISTINCT page, ',' ORDER BY page) AS source_pages FROM k WHERE key <> '' GROUP BY ALL)
SELECT issue, page, ordinal, {FOLD.format(0.75)} AS body, source_pages FROM g""")
def cross_page_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir).filter(X.label_key(F.col("title")) != "")
    return A.merge_across_pages(rows).select("issue", "page", "ordinal", "body", F.array_join(F.col("source_pages").cast("array<string>"), ",").alias("source_pages"))


@register(rf"""WITH {ARTICLES}, k AS (SELECT *, {KEY.format("title")} AS key FROM a), l AS (SELECT *, lag(body) OVER (PARTITION BY issue, key ORDER BY ordinal) AS before FROM k WHERE key <> '')
SELECT ordinal AS doc_id, round(CASE WHEN len({TOKENS.format("body")}) = 0 THEN 0.0 ELSE len(list_filter({TOKENS.format("body")}, lambda t: list_contains({TOKENS.format("before")}, t))) / len({TOKENS.format("body")}) END, 4) AS overlap FROM l WHERE before IS NOT NULL""")
def fragment_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir).withColumn("key", X.label_key(F.col("title"))).filter("key <> ''")
    found = folds.overlaps_before(rows.select("issue", "key", "ordinal", "body"), ["issue", "key"], ["ordinal"])
    return found.filter("overlap is not null").select(F.col("ordinal").alias("doc_id"), F.round("overlap", 4).alias("overlap"))


@register(rf"""WITH {ARTICLES}, i AS (SELECT *, CASE WHEN ordinal % 3 = 0 THEN '' ELSE 'img' || ordinal % 5 END AS img FROM a),
g AS (SELECT issue, page, category, min(ordinal) AS ordinal, string_agg(ordinal, ',' ORDER BY ordinal) AS members FROM i WHERE img <> '' GROUP BY issue, page, category, img UNION ALL SELECT issue, page, category, ordinal, CAST(ordinal AS VARCHAR) FROM i WHERE img = '')
SELECT issue, page, ordinal, members FROM g""")
def related_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = F.when(F.col("ordinal") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("img"), F.col("ordinal") % 5)))
    merged = A.merge_related(articles(spark, sf_dir).withColumn("images", images))
    return merged.select("issue", "page", "ordinal", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@register(rf"""WITH {ARTICLES}, k AS (SELECT issue, page, ordinal, {KEY.format("title")} AS key FROM a), e AS (SELECT issue, key, page, max(ordinal) AS last FROM k WHERE key <> '' GROUP BY ALL)
SELECT k.issue, k.page, k.ordinal, max(e.last) AS target FROM k JOIN e ON k.issue = e.issue AND k.key = e.key AND e.page < k.page GROUP BY ALL""")
def exact_continuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.exact_continuations(articles(spark, sf_dir))


@register("""WITH b AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
g AS (SELECT *, sum(CASE WHEN before IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM b)
SELECT user_id, CAST(grp AS BIGINT) AS grp, event_type, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event FROM g GROUP BY ALL""")
def continued_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type").withColumn("new", F.when(F.lag("event_type").over(by).eqNullSafe(F.col("event_type")), 0).otherwise(1))
    rows = rows.withColumn("grp", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("user_id", "grp", "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))


ST = r"regexp_extract_all(lower({0}), '[a-z0-9]+(?:[\x27-][a-z0-9]+)?')"


@register(rf"""WITH {ARTICLES}, i AS (SELECT item_id, {ST.format("text")} AS t FROM benchmark), i2 AS (SELECT * FROM i WHERE len(t) >= 4),
ic AS (SELECT item_id, len(t) AS item_n, token, count(*) AS c FROM (SELECT item_id, t, unnest(t) AS token FROM i2) GROUP BY ALL), d AS (SELECT token, sum(c) AS c_dir FROM ic GROUP BY token),
b AS (SELECT ordinal, {ST.format("body")} AS t FROM a), c AS (SELECT ordinal, len(t) AS n, token, count(*) AS c_own FROM (SELECT ordinal, t, unnest(t) AS token FROM b) GROUP BY ALL),
v AS (SELECT ordinal, n, sum(least(c_own, c_dir)) AS hit FROM c JOIN d USING (token) GROUP BY ALL),
s AS (SELECT ordinal, item_id, item_n, sum(least(c_own, c)) AS hit FROM c JOIN ic USING (token) GROUP BY ALL),
m AS (SELECT DISTINCT v.ordinal FROM v JOIN s ON v.ordinal = s.ordinal WHERE v.n >= 4 AND v.hit / v.n >= 0.3 AND s.hit / s.item_n >= 0.6)
SELECT ordinal AS doc_id FROM a WHERE ordinal NOT IN (SELECT ordinal FROM m)""")
def bag_coverage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linking.outside_directory(articles(spark, sf_dir), table(spark, sf_dir, "benchmark"), coverage=0.3).select(F.col("ordinal").alias("doc_id"))


@register(r"""WITH l AS (SELECT doc_id, i, trim(regexp_replace(lower(ls[i]), '[^a-z0-9]+', ' ', 'g')) AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
f AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(f.line) AS n_boilerplate FROM l LEFT JOIN f ON l.line = f.line WHERE l.line <> '' GROUP BY doc_id""")
def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), "\\n")).alias("line")).withColumn("line", X.label_key(F.col("line"))).filter("line <> ''")
    # Lines of a document are counted once; the hot line is summed before it is shuffled.
    counts = lines.groupBy("doc_id", "line").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.groupBy("line").agg(F.count(F.lit(1)).alias("docs")).filter("docs >= 5").select("line", F.lit(1).alias("hit"))
    return counts.join(frequent, "line", "left").groupBy("doc_id").agg(F.sum("n").alias("n_lines"), F.sum(F.when(F.col("hit") == 1, F.col("n")).otherwise(0)).alias("n_boilerplate"))


@register(r"""WITH l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r FROM l), m AS (SELECT doc_id, line, count(*) AS c FROM l WHERE i % 3 = 0 GROUP BY ALL)
SELECT n.doc_id, CAST(n.i AS BIGINT) AS line_no FROM n LEFT JOIN m ON n.doc_id = m.doc_id AND n.line = m.line WHERE m.c IS NULL OR n.r > m.c""")
def module_line_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\\n")).alias("i", "line")).select("page", (F.col("i") + 1).cast("long").alias("line_no"), "line")
    left = linking.without_module_lines(lines, lines.filter("line_no % 3 = 0"))
    return left.select(F.col("page").alias("doc_id"), "line_no")


def _link(t: str) -> str:
    return rf"""list_distinct(list_transform(list_filter(regexp_extract_all(regexp_replace(lower({t}), '([a-z])-[ \t-\r]+([a-z])', '\1\2', 'g'), '[a-z0-9]+'), lambda x: length(x) >= 3 AND x NOT IN {linking.V.STOP_WORDS}),
  lambda x: CASE WHEN length(x) > 4 AND x LIKE '%ies' THEN left(x, length(x) - 3) || 'y' WHEN length(x) > 4 AND x LIKE '%s' AND x NOT LIKE '%ss' THEN left(x, length(x) - 1) ELSE x END))"""


@register(rf"""WITH {ARTICLES}, q AS (SELECT item_id, {_link("text")} AS t FROM benchmark), d AS (SELECT ordinal, {_link("title")} AS tt, {_link("body")} AS bt FROM a),
p AS (SELECT q.item_id, d.ordinal, count(*) AS hits FROM (SELECT item_id, unnest(t) AS w FROM q) q JOIN (SELECT ordinal, unnest(tt) AS w FROM d) d USING (w) GROUP BY ALL HAVING count(*) >= 2),
s AS (SELECT p.item_id, p.ordinal, 7 * p.hits + len(list_intersect(q.t, d.bt)) AS score FROM p JOIN q USING (item_id) JOIN d USING (ordinal)),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, ordinal) AS r FROM s WHERE score >= 14)
SELECT item_id, ordinal, CAST(score AS BIGINT) AS score FROM r WHERE r = 1""")
def directory_link_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linking.directory_links(table(spark, sf_dir, "benchmark"), articles(spark, sf_dir))


@register()
def directory_link_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every title is an item of its issue's directory. An issue is a source's rows among a thousand ids, as print would bound it."""
    issue = F.concat_ws("/", "issue", F.expr("ordinal div 1000").cast("string"))
    rows = articles(spark, sf_dir).withColumn("issue", issue).withColumn("label", F.concat(F.lit("A"), (F.col("ordinal") % 90).cast("string")))
    items = rows.select("issue", F.col("ordinal").alias("item_id"), F.col("title").alias("text"), F.when(F.col("ordinal") % 2 == 0, F.col("label")).alias("label"), F.lit(None).cast("long").alias("explicit"))
    return linking.unique_directory_links(items, rows)


@register("""WITH r AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) ELSE n_name || '?' END AS category FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, category, CASE WHEN c_custkey % 3 < 2 THEN 'N' || n_nationkey END AS name, CASE c_custkey % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'case' ELSE 'none' END AS how FROM r LEFT JOIN nation ON upper(category) = n_name""")
def dimension_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    k = F.col("c_custkey") % 3
    category = F.when(k == 0, F.col("n_name")).when(k == 1, F.lower("n_name")).otherwise(F.concat("n_name", F.lit("?")))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", category.alias("category"))
    dimension = nation.select(F.col("n_name").alias("category"), F.concat(F.lit("N"), F.col("n_nationkey")).alias("name"), F.col("n_nationkey").alias("position"))
    return linking.lookup_category(rows, dimension)


PREFIXES = ("STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO")


@register(f"""SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN split_part(p_type, ' ', 1) || '_' || substr(p_type, strpos(p_type, ' ') + 1) ELSE split_part(p_type, ' ', 1) END AS category FROM part WHERE split_part(p_type, ' ', 1) IN {PREFIXES}""")
def prefix_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    head, tail = F.substring_index("p_type", " ", 1), F.expr("substr(p_type, instr(p_type, ' ') + 1)")
    raw = F.when(k == 0, F.lower(head)).when(k == 1, F.concat(F.lower(head), F.lit(" / "), tail)).when(k == 2, F.concat(head, F.lit(" - "), tail)).otherwise(F.concat(head, F.lit("_"), tail))
    rows = table(spark, sf_dir, "part").filter(head.isin(*PREFIXES)).select("p_partkey", raw.alias("raw"))
    return rows.select("p_partkey", linking.standard_category(F.col("raw"), PREFIXES).alias("category"))


CATEGORIES = [(1, "opinion / americas"), (2, "Arts in Review - Art"), (3, "Personal Journal — Health"), (4, ""), (5, "Gardening"), (6, "LETTERS"), (7, "Review & Outlook/x")]


@register("SELECT * FROM (VALUES (1, 'OPINION'), (2, 'ARTS IN REVIEW'), (3, 'PERSONAL JOURNAL'), (4, 'General'), (5, 'Gardening'), (6, 'Letters'), (7, 'REVIEW & OUTLOOK')) t(id, category)")
def standard_category_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(CATEGORIES, "id int, category string")
    return rows.select("id", linking.standard_category(F.col("category")).alias("category"))


@register("""WITH s AS (SELECT conv_id AS issue, turn AS ordinal, turn % 5 AS page, CASE WHEN turn % 2 = 0 THEN [turn % 5, turn % 5 + 1] ELSE [turn % 5] END AS pages FROM conversations),
p AS (SELECT DISTINCT issue, page AS pdf_page FROM s)
SELECT p.issue, p.pdf_page, coalesce(string_agg('t' || s.ordinal, ',' ORDER BY s.ordinal), '') AS article_ids FROM p LEFT JOIN s ON p.issue = s.issue AND list_contains(s.pages, p.pdf_page) GROUP BY ALL""")
def page_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn").cast("long")
    two = F.when(turn % 2 == 0, F.array(turn % 5, turn % 5 + 1))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), F.concat(F.lit("t"), turn).alias("id"), turn.alias("ordinal"), (turn % 5).alias("page"), two.alias("source_pages"))
    pages = rows.select("issue", F.col("page").alias("pdf_page")).distinct()
    return linking.page_membership(pages, rows).select("issue", "pdf_page", F.array_join("article_ids", ",").alias("article_ids"))


@register("""WITH e AS (SELECT o_custkey AS id, o_orderkey AS seq, o_orderstatus AS term FROM orders), l AS (SELECT id, arg_max(term, seq) AS term FROM e GROUP BY id)
SELECT id AS glossary_id, term FROM l WHERE id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def glossary_referenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("glossary_id"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("term"))
    used = table(spark, sf_dir, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("glossary_id"))
    return glossary.referenced(entries, used)


@register("""SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN 1 WHEN l.doc_id IS NOT NULL THEN l.quality END AS quality, CASE WHEN d.doc_id % 3 = 0 THEN 0 WHEN l.doc_id IS NOT NULL THEN l.toxic END AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)""")
def glossary_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = F.col("doc_id") % 3 == 0
    labels = table(spark, sf_dir, "labels")
    current = table(spark, sf_dir, "documents").select("doc_id", F.when(fresh, 1).cast(labels.schema["quality"].dataType).alias("quality"), F.when(fresh, 0).cast(labels.schema["toxic"].dataType).alias("toxic"))
    return issues.carry_forward(current, labels, "doc_id", ["quality", "toxic"], F.col("quality").isNotNull())


LEDGER = "SELECT event_id AS sha256, user_id || '|' || event_type AS fingerprint_key, CAST(event_id AS VARCHAR) AS filename, value AS size, ts AS processed_at FROM events"


@register(f"""WITH l AS ({LEDGER}) SELECT fingerprint_key, arg_min(filename, (processed_at, sha256)) AS filename, arg_max(sha256, (processed_at, sha256)) AS sha256, arg_max(size, (processed_at, sha256)) AS size, max(processed_at) AS processed_at FROM l GROUP BY fingerprint_key""")
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("sha256"), F.concat_ws("|", "user_id", "event_type").alias("fingerprint_key"), F.col("event_id").cast("string").alias("filename"), F.col("value").alias("size"), F.col("ts").alias("processed_at"))
    old, new = rows.filter("processed_at < timestamp'2024-01-03'"), rows.filter("processed_at >= timestamp'2024-01-03'")
    first = issues.ledger_upsert(old.limit(0), old, fixed=("filename",))
    return issues.ledger_upsert(first, new, fixed=("filename",)).select("fingerprint_key", "filename", "sha256", "size", "processed_at")


@register("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def ledger_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("database_path"))
    ledger = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("output_path"))
    return issues.ledger_reconcile(ledger, index).select("o_orderkey", F.col("output_path").alias("o_custkey"))


@register("""SELECT event_id FROM events WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'error') OR user_id IN (SELECT user_id FROM events WHERE value > 200)""")
def already_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    files = events.select("event_id", F.col("event_id").alias("sha256"), F.col("user_id").alias("fingerprint_key"))
    known = events.filter("event_type = 'error'").select(F.col("event_id").alias("sha256"), F.lit(None).cast(events.schema["user_id"].dataType).alias("fingerprint_key")).unionByName(events.filter("value > 200").select(F.lit(None).cast(events.schema["event_id"].dataType).alias("sha256"), F.col("user_id").alias("fingerprint_key")))
    return issues.already_processed(files, known).select("event_id")


@register("""WITH i AS (SELECT o_orderkey AS id, o_orderpriority AS kind, o_orderdate AS day, o_totalprice AS total FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_orderpriority, o_orderdate, 1.5 FROM orders WHERE o_orderkey % 3 = 0)
SELECT id, CASE WHEN bool_or(total = 1.5) THEN 1.5::DOUBLE ELSE max(total)::DOUBLE END AS total FROM i GROUP BY id""")
def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("publication_type"), F.col("o_orderdate").alias("publication_date"), F.col("o_orderkey").cast("string").alias("original_filename"), F.col("o_totalprice").cast("double").alias("total"))
    return issues.index_upsert(orders.filter("id % 2 = 0"), orders.filter("id % 3 = 0").withColumn("total", F.lit(1.5))).select("id", "total")


@register("""WITH i AS (SELECT o_orderkey, o_orderpriority, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'TE' ELSE 'FT' END AS kind FROM orders)
SELECT o_orderkey AS id, kind AS publication_type, 'primary' AS database_root FROM i WHERE kind <> 'TE' UNION ALL SELECT o_orderkey + 1000000, 'TE', 'external' FROM i WHERE o_orderkey % 10 = 0""")
def index_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("id"))
    own = orders.withColumn("publication_type", F.when(F.col("id") % 5 == 0, "TE").otherwise("FT"))
    other = orders.filter("id % 10 = 0").select((F.col("id") + 1000000).alias("id"), F.lit("TE").alias("publication_type"))
    return issues.index_union(own, other)


@register("""WITH i AS (SELECT conv_id AS issue, CAST(max(turn) + 3 AS BIGINT) AS page_count FROM conversations GROUP BY conv_id), c AS (SELECT conv_id AS issue, CAST(turn + 1 AS BIGINT) AS page FROM conversations WHERE role <> 'assistant'),
x AS (SELECT issue, page_count, unnest(range(1, page_count + 1)) AS page FROM i), m AS (SELECT x.* FROM x LEFT JOIN c USING (issue, page) WHERE c.issue IS NULL)
SELECT issue, any_value(page_count) AS page_count, count(*) AS n_missing, array_to_string(list_slice(list(page ORDER BY page), 1, 8), ',') AS first_missing FROM m GROUP BY issue""")
def incomplete_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    all_issues = rows.groupBy(F.col("conv_id").alias("issue")).agg((F.max("turn") + 3).cast("long").alias("page_count"))
    done = rows.filter("role <> 'assistant'").select(F.col("conv_id").alias("issue"), (F.col("turn") + 1).cast("long").alias("page"))
    found = issues.completeness(all_issues, issues.missing_pages(all_issues, done)).filter(~F.col("complete"))
    return found.select("issue", "page_count", "n_missing", F.array_join(F.col("first_missing").cast("array<string>"), ",").alias("first_missing"))


@register("""SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS sections, count(*) AS n FROM documents GROUP BY source""")
def section_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("sections"), F.count(F.lit(1)).alias("n"))


@register("""SELECT CASE WHEN doc_id % 4 = 0 THEN 'BARRONS_2026-01-05_barrons-weekly' ELSE 'FT_2026-01-05_' || coalesce(nullif(regexp_replace(regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'paper') END AS issue_id,
CASE WHEN doc_id % 4 = 0 THEN printf('art_2026-01-05_%03d', doc_id) ELSE 'FT_2026-01-05_' || coalesce(nullif(regexp_replace(regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'paper') || printf('_p%02d_%02d', doc_id // 100, doc_id % 100) END AS article_id FROM documents""")
def article_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, day = F.when(F.col("doc_id") % 4 == 0, "BARRONS").otherwise("FT"), F.lit("2026-01-05").cast("date")
    issue = issues.issue_id(kind, day, F.col("source"))
    return table(spark, sf_dir, "documents").select(issue.alias("issue_id"), issues.article_id(issue, kind, day, F.expr("doc_id div 100"), F.col("doc_id") % 100, F.col("doc_id")).alias("article_id"))


@register("""WITH b AS (SELECT doc_id, source, split_part(split_part(coalesce(text, ''), chr(10), 1), ' ', 1) AS base FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY source, base ORDER BY doc_id) AS r FROM b) SELECT doc_id, CASE WHEN r = 1 THEN base ELSE base || '_' || r END AS name FROM n""")
def unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.substring_index(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1), " ", 1)
    return issues.unique_names(table(spark, sf_dir, "documents").select("doc_id", "source", base.alias("base")), ["source"], "base", "doc_id").select("doc_id", "name")


@register("""SELECT conv_id, turn, replace(replace(text, 'the', '<1>'), 'and', '<2>') AS text FROM conversations""")
def asset_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(F.lit("the"), F.lit("<1>"), F.lit("and"), F.lit("<2>"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", issues.rename_assets(F.col("text"), names).alias("text"))


@register("""SELECT conv_id AS issue, turn AS ordinal, turn % 3 AS page, row_number() OVER (PARTITION BY conv_id ORDER BY turn % 3, turn) AS article_index, row_number() OVER (PARTITION BY conv_id, turn % 3 ORDER BY turn) AS page_article_index FROM conversations""")
def reindex_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), F.col("turn").alias("ordinal"), (F.col("turn") % 3).alias("page"))
    return A.reindex(rows)


@register("""WITH p AS (SELECT conv_id AS issue, turn - 1 AS pdf_page FROM conversations), r AS (SELECT *, row_number() OVER (PARTITION BY issue ORDER BY pdf_page) AS page_order FROM p) SELECT * FROM r WHERE pdf_page > 0""")
def issue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.page_fields(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), (F.col("turn") - 1).alias("pdf_page")))


@register("""SELECT doc_id, array_to_string(list(split_part(text, chr(10), 1)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '|') AS earlier FROM documents""")
def prior_titles_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("source").orderBy("doc_id").rowsBetween(-3, -1)
    found = F.array_join(F.collect_list(F.substring_index("text", "\n", 1)).over(by), "|")
    # An empty history is null, as a list of nothing is in SQL.
    return table(spark, sf_dir, "documents").select("doc_id", F.nullif(found, F.lit("")).alias("earlier"))


@register(rf"""WITH {ARTICLES}, n AS (SELECT ordinal, len(regexp_extract_all(body, '[A-Za-z0-9]+(?:[\x27-][A-Za-z0-9]+)?')) AS n FROM a)
SELECT ordinal AS doc_id, CAST(least(7000, greatest(5000, floor(3500 + 3.5 * n))) AS BIGINT) AS tokens, CAST(CASE WHEN n <= 900 THEN 420 WHEN n <= 1800 THEN 520 ELSE 620 END AS INT) AS low FROM n""")
def compile_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir)
    return rows.select(F.col("ordinal").alias("doc_id"), A.compile_budget(F.col("body")).alias("tokens"), A.summary_band(X.word_count(F.col("body")))["low"].alias("low"))


@register()
def fuzzy_continuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy.fuzzy_continuations(articles(spark, sf_dir))


@register()
def issue_export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).select(F.col("ordinal").alias("doc_id"), exports.issue_json("ordinal", "issue", "page", "title", "category", "body").alias("payload"))


@register("""WITH c AS (SELECT DISTINCT lang AS category FROM documents WHERE lang IS NOT NULL AND lang <> ''), d(category, name, position) AS (VALUES ('en', 'English', 0), ('fr', 'French', 1))
SELECT category, name, CAST(position AS BIGINT) AS position FROM d UNION ALL SELECT category, '', NULL FROM c WHERE category NOT IN (SELECT category FROM d)""")
def category_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = spark.createDataFrame([("en", "English", 0), ("fr", "French", 1)], "category string, name string, position long")
    return exports.unseen_categories(table(spark, sf_dir, "documents").select(F.col("lang").alias("category")), dimension)
