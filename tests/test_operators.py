import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from broadsheet.functions import dates
from broadsheet.functions import text as X
from broadsheet.operators import articles, enrichment, fuzzy, glossary, issues, layout, linking, reader
from broadsheet.sources import exports, files
from broadsheet.streaming import ingest
from tests.conftest import values


def one(spark, column, **kinds):
    """A column's value on a single row."""
    df = spark.createDataFrame([tuple(v for v, _ in kinds.values())], ", ".join(f"{k} {t}" for k, (_, t) in kinds.items()))
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("name", "kind", "day"),
    [
        ("WSJ-2026-07-27.pdf", "WSJ", dt.date(2026, 7, 27)),
        ("Financial Times July 25, 2026.pdf", "FT", dt.date(2026, 7, 25)),
        ("[2026] barrons sept 7 2026.pdf", "BARRONS", dt.date(2026, 9, 7)),
        ("The Economist 2026_2_31.pdf", "TE", None),
        ("other.pdf", "General", None),
    ],
)
def test_file_names(spark, name, kind, day):
    assert one(spark, dates.publication_type(F.col("n")), n=(name, "string")) == kind
    assert one(spark, dates.publication_date(F.col("n")), n=(name, "string")) == day


def test_truncation_and_errors(spark):
    long = "一" * 120 + "。" + "二" * 200
    assert one(spark, X.truncate_at_sentence(F.col("t")), t=(long, "string")) == "一" * 120 + "。"
    assert one(spark, X.truncate_at_sentence(F.col("t")), t=("一。" + "x" * 197 + ",yyyy", "string")) == "一。" + "x" * 197 + "…"
    assert one(spark, X.truncate_at_sentence(F.col("t")), t=("x" * 200, "string")) == "x" * 200
    assert len(one(spark, X.compact_error(F.col("t")), t=("e " * 500, "string"))) == 220


def test_english_names_in_chinese(spark):
    text = "美联储 Federal Reserve 与 federal reserve，还有 inflation、GPT-4 和 U.S. Steel。"
    assert one(spark, X.english_in_cjk(F.col("t"), 3), t=(text, "string")) == ["Federal Reserve", "GPT-4", "U.S"]


def test_occurrences_keep_the_surface(spark):
    assert one(spark, X.occurrences(F.col("t"), "U.S."), t=("The u.s. and U.S., not XU.S.", "string")) == ["u.s.", "U.S."]


def test_fallbacks(spark):
    assert one(spark, X.to_int(F.col("t"), 7), t=(" 12 ", "string")) == 12
    assert one(spark, X.to_int(F.col("t"), 7), t=("x", "string")) == 7
    assert one(spark, X.or_else(F.col("t"), F.lit("d")), t=("  ", "string")) == "d"
    assert one(spark, X.guess_title(F.col("t")), t=("abc\nA longer line\n", "string")) == "A longer line"
    assert one(spark, articles.page_fallback(F.col("t"), F.col("p")), t=("abc", "string"), p=(3, "int"))["title"] == "Page 3 OCR Text"


def test_continued_rows_join_their_base(spark):
    rows = spark.createDataFrame([("i", 1, 1, "Oil", "a b c", "x"), ("i", 1, 2, "Oil (Continued)", "d e f", "x"), ("i", 1, 3, "Gas", "g", "x")], "issue string, page int, ordinal int, title string, body string, category string")
    found = values(articles.merge_continued(rows).select("ordinal", "members"), "ordinal")
    assert found == [(1, [1, 2]), (3, [3])]


def test_suspicious_pairs(spark):
    rows = spark.createDataFrame([("i", 1, 1, "Oil price rises"), ("i", 1, 2, "Oil price rises again"), ("i", 1, 3, "Gas")], "issue string, page int, ordinal int, title string")
    assert values(articles.suspicious_pairs(rows)) == [("i", 1, 1, 2)]


def test_compile_predicate(spark):
    kind = "body string, compiled_article boolean, title_zh string, summary_md string, paragraphs array<struct<zh_text string>>"
    rows = spark.createDataFrame([("b", None, "", "", []), ("b", True, "", "", []), ("b", False, "t", "s", [Row(zh_text="z")]), (" ", False, "", "", [])], kind)
    assert [r["v"] for r in rows.select(articles.needs_compile(rows).alias("v")).collect()] == [True, False, False, False]


def test_links_are_one_to_one_and_explicit_wins(spark):
    items = spark.createDataFrame([("i", 1, "Oil price rises", "A1", None), ("i", 2, "Oil price rises more", "A1", None), ("i", 3, "Other", None, 10)], "issue string, item_id long, text string, label string, explicit long")
    arts = spark.createDataFrame([("i", 10, "Oil price rises", "body", "A1"), ("i", 11, "Oil price rises more", "body", "a1"), ("i", 12, "Gas", "body", "B1")], "issue string, ordinal long, title string, body string, label string")
    assert values(linking.unique_directory_links(items, arts), "item_id") == [("i", 1, 10), ("i", 2, 11), ("i", 3, 10)]


def test_ledger_keeps_first_names_and_updates_the_rest(spark):
    kind = "sha256 string, fingerprint_key string, filename string, publication_type string, publication_date string, size int, processed_at int"
    old = spark.createDataFrame([("a", "k", "first", "FT", "d", 1, 1)], kind)
    new = spark.createDataFrame([("b", "k", "second", "FT", "e", 2, 2), ("c", "n", "third", "TE", "d", 3, 3)], kind)
    once = issues.ledger_upsert(old, new)
    assert values(once, "fingerprint_key") == [("b", "k", "first", "FT", "d", 2, 2), ("c", "n", "third", "TE", "d", 3, 3)]
    assert values(issues.ledger_upsert(once, new), "fingerprint_key") == values(once, "fingerprint_key")
    index = spark.createDataFrame([], "database_path string")
    assert issues.ledger_reconcile(old.withColumn("output_path", F.lit("p")), index).count() == 1


def test_three_state_writes(spark):
    rows = spark.createDataFrame([("keep", "new"), ("clear", "new"), ("replace", "new")], "a string, v string")
    assert [r["w"] for r in rows.select(issues.write_action(F.lit("old"), F.col("a"), F.col("v")).alias("w")).collect()] == ["old", None, "new"]


def test_names_do_not_collide(spark):
    rows = spark.createDataFrame([("g", "a", 1), ("g", "a", 2), ("g", "a_2", 3), ("g", "b", 4)], "g string, base string, n int")
    names = [r["name"] for r in issues.unique_names(rows, ["g"], "base", "n").orderBy("n").collect()]
    assert names[0] == "a" and names[2] == "a_2" and names[3] == "b" and len(set(names)) == 4


def test_asset_maps(spark):
    names = F.create_map(F.lit("p1.png"), F.lit("a.png"), F.lit("xp1.png"), F.lit("b.png"))
    assert one(spark, issues.rename_assets(F.col("t"), names), t=("see xp1.png and p1.png", "string")) == "see b.png and a.png"
    assert one(spark, issues.rename_list(F.col("t"), names), t=(["p1.png", "q"], "array<string>")) == ["a.png", "q"]


def test_sampling_rounds_halves_to_even(spark):
    assert one(spark, layout.sample_pages(F.col("n")), n=(6, "long")) == [0, 2, 5]
    assert one(spark, layout.sample_pages(F.col("n")), n=(2, "long")) == [0, 1]


def test_reference_lines(spark):
    assert one(spark, layout.is_reference_line(F.col("t")), t=("Please turn to page A5", "string"))
    assert not one(spark, layout.is_reference_line(F.col("t")), t=("Turn the page", "string"))
    assert one(spark, layout.is_reference_line(F.col("t"), F.col("b")), t=("A5", "string"), b=("Continued on page", "string"))
    assert one(spark, layout.numeric_label(F.col("t"), "FINANCIAL TIMES"), t=("12 Financial Times", "string")) == "12"


def test_layout_enrichment(spark):
    merge = layout.enrich_layout(F.col("o"), F.col("n"), F.lit(True), "merge")
    assert one(spark, merge, o=("old", "string"), n=(None, "string")) == "old"
    assert one(spark, layout.enrich_layout(F.col("o"), F.col("n"), F.lit(True), "replace"), o=("old", "string"), n=(None, "string")) is None
    assert one(spark, layout.enrich_layout(F.col("o"), F.col("n"), F.lit(False), "replace"), o=("old", "string"), n=("new", "string")) == "old"


def test_glossary(spark):
    for term, good in [("NATO", True), ("market", False), ("rate", False), ("Federal Reserve", True), ("G7", True), ("x", False), ("US", False)]:
        assert one(spark, glossary.is_proper_term(F.col("t")), t=(term, "string")) is good
    paragraphs = spark.createDataFrame([("a", 0, "U.S. and u.s. bonds"), ("a", 1, "no term")], "article string, paragraph int, text string")
    terms = spark.createDataFrame([("a", "g", "U.S.")], "article string, glossary_id string, term string")
    assert values(glossary.locate(paragraphs, terms).select("paragraph", "surface", "occurrence"), "occurrence") == [(0, "U.S.", 1), (0, "u.s.", 2)]
    notes = spark.createDataFrame([("a", 0, "s", 1, "g", 1), ("a", 0, "s", 1, "g", 2), ("a", 1, "s", 1, "g", 3), ("a", 2, "s", 1, "g", 4)], "article string, paragraph int, surface string, occurrence int, glossary_id string, seq int")
    assert [r["seq"] for r in glossary.distinct_places(notes).orderBy("seq").collect()] == [1, 3]


def test_tolerant_json():
    assert fuzzy.parse_tolerant('<think>{"a": 0}</think>text ```json\n{"a": 1}\n```') == {"a": 1}
    assert fuzzy.parse_tolerant('noise {bad} [1, 2] {"b": 2}') == [1, 2]
    assert fuzzy.parse_tolerant("nothing") is None and fuzzy.parse_tolerant(None) is None


def test_segmenter_and_hyphens(spark):
    lexicon = {"market": 50, "rally": 20, "well": 30, "known": 25, "government": 40}
    s = fuzzy.Segmenter(lexicon)
    assert s.split("marketrally") == ["market", "rally"] and s.split("government") == ["government"]
    assert one(spark, fuzzy.repair_hyphens(F.col("t"), lexicon), t=("govern- ment is well- known", "string")) == "government is well-known"


def test_model_calls_fall_back(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    assert values(enrichment.call(rows, "summary", ["text"]).select("id", "reply", "reply_error"), "id") == [(1, None, None), (2, None, None)]

    class Loud:
        def complete(self, task, payload):
            if payload["text"] == "b":
                raise ValueError("no")
            return {"task": task, "length": len(payload["text"])}

    found = values(enrichment.call(rows, "t", ["text"], Loud()).select("id", "reply", "reply_error"), "id")
    assert found == [(1, '{"task": "t", "length": 1}', None), (2, None, "no")]
    tried = []

    class Failing:
        def complete(self, task, payload):
            tried.append(1)
            raise OSError("down")

    assert enrichment.RetryingClient([Failing(), Loud()], wait=0).complete("t", {"text": "xy"}) == {"task": "t", "length": 2} and len(tried) == 3


def test_summary_and_translation_rules(spark):
    assert one(spark, enrichment.accept_summary(F.col("t")), t=("一段。\n\n二段。\n\n三段。", "string"))
    assert not one(spark, enrichment.accept_summary(F.col("t")), t=("- 一\n\n二\n\n三", "string"))
    assert one(spark, enrichment.accept_longer(F.col("a"), F.col("b")), a=("long text", "string"), b=("x", "string")) == "long text"
    assert one(spark, enrichment.text_of_reply(F.col("t")), t=('{"choices": [{"text": "hi"}]}', "string")) == "hi"


def test_reader_small_functions(spark):
    assert one(spark, reader.asset_path(F.lit("data/"), F.col("p"), F.lit("./images/a.png")), p=("FT/2026/database.js", "string")) == "data/FT/2026/images/a.png"
    assert one(spark, reader.default_publication(F.lit(""), F.col("s"), F.lit("WSJ")), s=("FT", "string")) == "FT"
    assert one(spark, reader.display_case(F.col("t")), t=("THE STATE OF THE UK", "string")) == "The State of the UK"


def test_files_and_discovery(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = b"%PDF-1.7 " + b"x" * 2000 + b"%%EOF\n"
    (tmp_path / "in/FT-2026-07-25.pdf").write_bytes(good)
    (tmp_path / "in/cut.pdf").write_bytes(b"%PDF-1.7 " + b"x" * 2000)
    (tmp_path / "in/tiny.pdf").write_bytes(b"%%EOF")
    listed = files.list_files(spark, str(tmp_path / "in"), content=True)
    assert {(r["stem"], r["has_eof"]) for r in listed.collect()} == {("FT-2026-07-25", True), ("cut", False), ("tiny", True)}
    config = files.WatchConfig(str(tmp_path / "in"), settle_seconds=0, selection_mode="all_unprocessed", poll_seconds=1)
    assert config.poll_seconds == 5
    ledger = spark.createDataFrame([], "sha256 string")
    new = ingest.discover(spark, config, ledger)
    assert [r["stem"] for r in new.collect()] == ["FT-2026-07-25"]
    assert ingest.discover(spark, config, new.select("sha256")).count() == 0
    with pytest.raises(ValueError):
        files.WatchConfig("x", selection_mode="other")
    assert files.page_selector("2,4-6,3-2") == [2, 3, 4, 5, 6]


def test_databases_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("FT", "2026-07-25", "FT_1", None, 3)], "publication_type string, publication_date string, id string, cover_image string, article_count int")
    payload = exports.issue_json("id", "cover_image", "article_count")
    out = str(tmp_path / "db")
    exports.write_issue_databases(rows.withColumn("payload", payload), out)
    read = files.read_wrapped(spark, f"{out}/*/*/*.txt", "id string, cover_image string, article_count int")
    found = read.select("publication_type", "data.*").first()
    assert found["id"] == "FT_1" and found["cover_image"] is None and found["article_count"] == 3
    assert found["publication_type"].endswith("FT")


def test_checkpoints_replace_pages_and_skip_errors(spark, tmp_path):
    out = str(tmp_path / "pages")
    kind = "issue string, page int, text string, error string"
    exports.write_checkpoints(spark.createDataFrame([("i", 1, "a", None), ("i", 2, "b", "bad")], kind), out)
    exports.write_checkpoints(spark.createDataFrame([("i", 1, "c", None), ("i", 3, "d", None)], kind), out)
    assert values(spark.read.parquet(out).select("page", "text"), "page") == [(1, "c"), (3, "d")]


def test_broken_json_is_a_row(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"page": 1}')
    (tmp_path / "b.json").write_text('{"page": ')
    found = files.read_checkpoints(spark, str(tmp_path), "page int").cache()
    assert found.filter("_corrupt is not null").count() == 1 and found.filter("page = 1").count() == 1
    assert files.read_dimension(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "d.json").write_text('{"ARTS": "x", "B": "y"}')
    assert values(files.read_dimension(spark, str(tmp_path / "d.json")), "position") == [("ARTS", "x", 0), ("B", "y", 1)]


def test_block_files(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"page": 1, "page_width": 634, "page_height": 1219, "blocks": [{"bbox": [1, 2, 3, 4], "text": "A1"}, {"bbox": [1], "text": "x"}, {"id": "k", "bbox": [5, 6, 7, 8], "text": "B"}]}')
    assert values(files.read_blocks(spark, str(tmp_path)).select("id", "x0", "y1"), "x0") == [("b001", 1.0, 4.0), ("k", 5.0, 8.0)]


def test_markdown_and_covers(spark):
    rows = spark.createDataFrame([("i", 2, 1, "B", "", "two"), ("i", 1, 1, "", "News", "one")], "issue string, page int, ordinal int, title string, category string, body string")
    text = exports.issue_markdown(rows).first()["markdown"]
    assert text.startswith("# Untitled\n\n- Category: News\n- Page: 1\n\none") and text.index("one") < text.index("two")
    images = spark.createDataFrame([("i", "x/page_1_fig_2.png"), ("i", "x/page_1_fig_1.png"), ("j", "y/cover.jpg"), ("j", "y/page_1_fig_1.png")], "issue string, path string")
    assert values(exports.cover_image(images), "issue") == [("i", "x/page_1_fig_1.png"), ("j", "y/cover.jpg")]


def test_commit_and_stale(spark):
    batch = spark.createDataFrame([("a", [], 1, 3, 3), ("b", [2], 1, 3, 3), ("c", [], 0, 3, 3), ("d", [], 1, 2, 3)], "id string, failed_pages array<int>, article_count int, pages_done int, page_count int")
    assert [r["id"] for r in ingest.commit_complete(batch, lambda x: x).collect()] == ["a"]
    rows = spark.createDataFrame([("a", 5), ("b", 4), ("c", None)], "id string, v int")
    assert sorted(r["id"] for r in ingest.stale(rows, {"v": 5}).collect()) == ["b", "c"]


def test_stream_equals_batch_in_several_batches(spark, tmp_path):
    source = tmp_path / "events"
    for n in range(3):
        spark.createDataFrame([(k, dt.datetime(2024, 1, 1, n)) for k in ("a", "b", f"c{n}")], "k string, ts timestamp").write.parquet(str(source / str(n)))
    stream = spark.readStream.schema("k string, ts timestamp").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 2).parquet(str(source))
    found = ingest.available_table(ingest.dedupe_stream(stream, ["k"], "ts", "10 days"), str(tmp_path / "out"))
    assert sorted(r["k"] for r in found.collect()) == ["a", "b", "c0", "c1", "c2"]
