"""Ordered folds against plain loops; images, adapters and small issue operators."""

import random
import re
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from broadsheet.operators import articles as A
from broadsheet.operators import enrichment, folds, images, issues, pages, reader
from broadsheet.sources import exports, renders

KEY = lambda t: re.sub("[^a-z0-9]+", " ", t.lower()).strip()


def brute_merge(rows):
    """The cross-page merge of one issue: rows (page, ordinal, title, body)."""
    base_of = lambda t: re.sub(r"(?i)^continued\s*[:\-]\s*", "", re.sub(r"(?i)\s*\(?\s*continued\s*\)?\s*$", "", t)).strip()
    kept = []
    for page, ordinal, title, body in sorted(rows):
        marked = bool(re.search(r"(?i)\bcontinued\b", title))
        hit = next((k for k in reversed(kept) if KEY(title) and k["page"] != page and KEY(k["title"]) == KEY(title)), None)
        base = base_of(title)
        if hit is None and marked and KEY(base):
            best = None
            for k in kept[-20:]:
                other = KEY(k["title"])
                if other == KEY(base):
                    hit = k
                    break
                if other:
                    a, b = set(KEY(base).split()), set(other.split())
                    s = max(SequenceMatcher(None, KEY(base), other).ratio(), len(a & b) / min(len(a), len(b)))
                    if s >= 0.72 and (best is None or s > best[0]):
                        best = (s, k)
            else:
                hit = best and best[1]
        if hit is None:
            kept.append({"page": page, "ordinal": ordinal, "title": (base or title) if marked else title, "body": body, "pages": [page]})
            continue
        new, old = re.findall("[a-z0-9]+", body.lower()), set(re.findall("[a-z0-9]+", hit["body"].lower()))
        if body and not (new and sum(t in old for t in new) / len(new) >= 0.75):
            hit["body"] = "\n\n".join(x for x in (hit["body"], body) if x)
        if page not in hit["pages"]:
            hit["pages"].append(page)
    return {(k["page"], k["ordinal"], k["title"], k["body"], tuple(k["pages"])) for k in kept}


def test_cross_page_merge_equals_a_loop(spark):
    rng = random.Random(7)
    names = ["Oil prices rise again", "Oil price rises again", "Court rules on trade", "Trade court ruling", "", "A quiet day"]
    rows = []
    for issue in ("a", "b"):
        for n in range(120):
            title = rng.choice(names) + rng.choice(["", "", " (continued)", " Continued"])
            title = rng.choice(["", "", "Continued: "]) + title if "ontinued" not in title else title
            rows.append((issue, n // 6 + 1, n, title, " ".join(rng.choice("ab cd ef gh ij kl mn op".split()) + str(rng.randint(0, 9)) for _ in range(rng.choice([0, 5, 30])))))
    df = spark.createDataFrame(rows, "issue string, page long, ordinal long, title string, body string").repartition(5)
    got = A.merge_continuations(df).collect()
    for issue in ("a", "b"):
        expected = brute_merge([r[1:] for r in rows if r[0] == issue])
        assert {(r["page"], r["ordinal"], r["title"], r["body"], tuple(r["source_pages"])) for r in got if r["issue"] == issue} == expected
    assert 2 < len(got) < len(rows)


def test_merge_takes_marks_images_and_blocks(spark):
    kind = "issue string, page long, ordinal long, title string, body string, is_continuation boolean, continuation_of string, images array<string>, source_block_ids array<string>"
    rows = [("i", 1, 1, "Main story here", "one two", None, None, ["x"], ["b1"]), ("i", 2, 2, "Other words", "three four", True, "Main story here", ["y", "x"], ["b1"]), ("i", 3, 3, "Lost part", None, True, None, None, None)]
    got = {r["ordinal"]: r for r in A.merge_continuations(spark.createDataFrame(rows, kind)).collect()}
    assert set(got) == {1, 3} and got[1]["body"] == "one two\n\nthree four" and got[1]["images"] == ["x", "y"] and got[1]["source_block_ids"] == ["b1", "b1"] and got[1]["source_pages"] == [1, 2]
    assert got[3]["title"] == "Lost part" and got[3]["body"] == ""


def test_names_take_the_next_free_number(spark):
    rows = [("g", 1, "a"), ("g", 2, "a_2"), ("g", 3, "a"), ("g", 4, "a"), ("g", 5, "a_2"), ("h", 6, "a")]
    got = folds.free_names(spark.createDataFrame(rows, "g string, n int, base string"), ["g"], "base", "n").orderBy("n").collect()
    assert [r["name"] for r in got] == ["a", "a_2", "a_3", "a_4", "a_2_2", "a"]


def test_module_lines_go_once_each_if_equal_or_alike(spark):
    lines = [(1, 1, "Diplomacy resumed after officials met."), (1, 2, "Diplomacy  resumed after officials met."), (1, 3, "Short line"), (1, 4, "Markets fell on Monday as oil rose agaln"), (1, 5, "Main Headline"), (2, 1, "Main Headline")]
    module = [(1, "Diplomacy resumed after officials met."), (1, "Short lime"), (1, "Markets fell on Monday as oil rose again")]
    got = folds.without_module(spark.createDataFrame(lines, "page int, line_no int, line string"), spark.createDataFrame(module, "page int, line string"))
    assert sorted(tuple(r)[:2] for r in got.collect()) == [(1, 2), (1, 3), (1, 5), (2, 1)]


def test_complex_section_gives_its_main_article(spark):
    kind = "page int, ordinal int, id string, x0 double, y0 double, x1 double, y1 double, text string, max_font_size double, median_font_size double, width double, height double"
    body = " ".join(["body"] * 100)
    rows = [(9, 1, "section", 22.0, 38.0, 253.0, 85.0, "REVIEW & PREVIEW", 40.0, 40.0, 756.0, 765.0), (9, 2, "title", 22.0, 321.0, 207.0, 414.0, "Overseas to the Rescue", 38.0, 38.0, 756.0, 765.0), (9, 3, "body", 22.0, 420.0, 171.0, 740.0, body, 8.8, 8.8, 756.0, 765.0), (9, 4, "far", 600.0, 420.0, 700.0, 740.0, "far " * 60, 8.8, 8.8, 756.0, 765.0)]
    rows += [(10, 1, "s", 22.0, 38.0, 253.0, 85.0, "MARKET WEEK", 40.0, 40.0, 756.0, 765.0), (10, 2, "t", 22.0, 300.0, 207.0, 340.0, "Stocks Slip a Little", 38.0, 38.0, 756.0, 765.0)]
    rows += [(11, 1, "s", 22.0, 38.0, 253.0, 85.0, "MARKET VIEW", 40.0, 40.0, 756.0, 765.0), (11, 2, "b", 22.0, 100.0, 207.0, 740.0, "view " * 310, 8.8, 8.8, 756.0, 765.0)]
    rows += [(12, 1, "s", 22.0, 38.0, 253.0, 85.0, "INSIDE SCOOP", 40.0, 40.0, 756.0, 765.0), (12, 2, "t", 22.0, 100.0, 207.0, 140.0, "A Chief Sells Shares", 38.0, 38.0, 756.0, 765.0), (12, 3, "b", 22.0, 150.0, 171.0, 300.0, "in " * 50, 8.8, 8.8, 756.0, 765.0), (12, 4, "n", 22.0, 400.0, 171.0, 420.0, "Another Headline Here", 18.0, 18.0, 756.0, 765.0), (12, 5, "c", 22.0, 430.0, 171.0, 700.0, "out " * 50, 8.8, 8.8, 756.0, 765.0)]
    blocks = spark.createDataFrame(rows, kind)
    got = {r["page"]: r for r in pages.complex_articles(blocks).collect()}
    assert (got[9]["title"], got[9]["category"], got[9]["block_ids"]) == ("Overseas to the Rescue", "REVIEW & PREVIEW", ["body"])
    assert got[10]["body"] == "Stocks Slip a Little" and got[10]["bypass_min_words"] and got[11]["title"] == "Market View"
    assert got[12]["block_ids"] == ["b"]
    assert {r["page"]: r["status"] for r in pages.page_status(blocks, least_words=10).collect()} == {9: "complex", 10: "skipped", 11: "complex", 12: "complex"}


def test_native_images(spark):
    rows = [(1, 0, 7, 0.0, 0.0, 50.0, 40.0, 600.0, 800.0), (1, 1, 7, 0.0, 0.0, 100.0, 80.0, 600.0, 800.0), (1, 2, 8, 0.0, 0.0, 44.0, 90.0, 600.0, 800.0), (1, 3, 9, 10.0, 10.0, 300.0, 300.0, 600.0, 800.0), (1, 4, 5, 5.0, 5.0, 5.0, 9.0, 600.0, 800.0)]
    got = images.native_images(spark.createDataFrame(rows, "page int, position int, xref int, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double")).orderBy("image").collect()
    assert [(r["image"], r["xref"], r["x1"], r["path"]) for r in got] == [(1, 7, 100.0, "images/page_1_fig_1.jpg"), (2, 9, 300.0, "images/page_1_fig_2.jpg")]


class Says:
    def __init__(self, reply):
        self.reply = reply

    def complete(self, task, payload):
        return self.reply


def test_models_are_asked_and_their_replies_checked(spark):
    blocks = spark.createDataFrame([(1, "b1", "one\ntwo"), (1, "b2", "three")], "page int, id string, text string")
    asked = spark.createDataFrame([(1, "first words of it and so on to the last words", "p")], "page int, text string, prompt string")
    native = Says({"articles": [{"title": "T", "category": "C", "content_block_ids": ["b2", "zz", "b1"]}, {"title": " ", "content_block_ids": ["b1"]}, {"title": "U", "content_block_ids": ["zz"]}]})
    assert [(r["title"], r["body"]) for r in enrichment.native_split(asked, blocks, native).collect()] == [("T", "three\n\none two")]
    assert enrichment.native_split(asked, blocks).count() == 0
    anchors = Says({"articles": [{"title": "A", "start_anchor": "first words", "end_anchor": "last words"}, {"title": "B", "start_anchor": "nowhere", "end_anchor": "at all"}]})
    assert [(r["title"], r["how"], r["body"]) for r in enrichment.anchor_split(asked, anchors).orderBy("title").collect()] == [("A", "slice", "first words of it and so on to the last words"), ("B", "anchors", "nowhere ... at all")]
    image = spark.createDataFrame([(1, bytearray(b"x"))], "page int, image binary")
    vision = Says({"articles": [{"title": "V", "content_markdown": " text "}, {"title": "W", "content_markdown": ""}]})
    assert [(r["title"], r["body"]) for r in enrichment.vision_articles(image, vision).collect()] == [("V", "text")]
    articles = spark.createDataFrame([(1, "t", "b", ["i1", "i2", "i3"]), (2, "t", "b", [])], "id int, title string, body string, images array<string>")
    insight = Says({"images": [{"path": "i1", "image_type": "chart", "description": 'say "x'}, {"path": "i2", "keep": False}, {"path": "other"}]})
    got = {r["id"]: r for r in enrichment.image_insights(articles, insight).collect()}
    assert got[1]["images"] == ["i1"] and got[1]["image_insights"][0]["description"] == images.CHART_MARK + " say 「x" and got[1]["image_analysis_complete"]
    assert got[2]["images"] == [] and not got[2]["image_analysis_complete"]
    shown = spark.createDataFrame([(["i1", "i2"], [("i1", "chart", "d")], "T")], "images array<string>, ins array<struct<path:string,image_type:string,description:string>>, t string")
    assert [tuple(x) for x in shown.select(images.captions(F.col("images"), F.col("ins"), F.col("t")).alias("c")).first()["c"]] == [("i1", "d", "chart"), ("i2", "T", "image")]


def test_adapters(spark):
    def broken(path):
        raise OSError(path)

    files = spark.createDataFrame([("a.pdf",), ("b.pdf",)], "path string")
    counted = renders.page_counts(files, [broken, lambda p: 3 if p == "a.pdf" else 0])
    assert {r["path"]: r["page_count"] for r in counted.collect()} == {"a.pdf": 3, "b.pdf": 0}
    two = renders.pages_of(counted, [1, 2, 9])
    read = renders.recognised(two, lambda p, n, dpi, part: f"{p}{n}{part[3]}", publication="FT").orderBy("page").collect()
    assert [(r["text"], r["header_text"], r["module_text"]) for r in read] == [("a.pdf11.0", "a.pdf10.18", "a.pdf11.0"), ("a.pdf21.0", "a.pdf20.18", None)]
    assert [r["text"] for r in renders.recognised(two).collect()] == [None, None]
    assert bytes(renders.rendered(two, lambda p, n, dpi: b"%d" % dpi).first()["image"]) == b"150"


def test_small_issue_operators(spark, tmp_path):
    page = spark.createDataFrame([("a", 1, True), ("a", 2, None), ("b", 1, False), ("b", 2, True)], "issue string, page long, is_weekend boolean")
    assert {r["issue"]: r["weekend"] for r in issues.weekend_issues(page).collect()} == {"a": True, "b": False}
    failed, pending = (spark.createDataFrame(x, "issue string, page long") for x in ([("a", 3), ("a", 0), ("a", 1)], [("a", 3), ("b", 2)]))
    assert {r["issue"]: r["pages"] for r in issues.pages_to_retry(failed, pending).collect()} == {"a": [1, 3], "b": [2]}
    assert [(r["page"], r["cached"]) for r in issues.work_order(page.filter("issue = 'a'").select("issue", "page"), failed).orderBy("place").collect()] == [(2, False), (1, True)]
    kind = "id string, publication_type string, publication_date string, database_path string, n int"
    one, two = spark.createDataFrame([("x", "FT", "d", "p", 1), (None, "FT", "d", "q", 1)], kind), spark.createDataFrame([("x", "FT", "d", "p", 2), ("", "FT", "d", "q", 2)], kind)
    assert sorted((r["database_path"], r["n"]) for r in issues.sources_union(one, two).collect()) == [("p", 2), ("q", 2)]
    entry = spark.createDataFrame([(("7", "t"), "WSJ"), (("7", "t"), "BARRONS")], "e struct<id:string,term:string>, k string")
    assert [r[0] for r in entry.select(issues.without_id(F.col("e"), F.col("k"))).collect()] == ['{"term":"t"}', '{"id":"7","term":"t"}']
    assert spark.createDataFrame([([" ", *"abcdefgh"],)], "i array<string>").select(images.capped(F.col("i"))).first()[0] == list("abcdef")
    results = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "y", "bad"), ("b", 1, "z", None)], "issue string, page int, body string, error string")
    final = exports.write_in_two_phases(results, f"file://{tmp_path}/out", lambda p: p.groupBy("issue").agg(F.count("*").alias("n")))
    assert {r["issue"]: r["n"] for r in final.collect()} == {"a": 1, "b": 1}
    assert "issue=b" in issues.issue_rows(spark, f"file://{tmp_path}/out/final", "b")._jdf.queryExecution().toString() or issues.issue_rows(spark, f"file://{tmp_path}/out/final", "b").count() == 1
    art = spark.createDataFrame([("A1", "NEWS", None, 3, "one two", None)], "label string, section string, category string, page int, body string, compiled boolean")
    assert art.select(reader.local_summary(art)).first()[0].split("\n")[1:5] == ["- 版面：A1 · NEWS", "- 分类：General", "- PDF 页码：3", "- 正文字数：约 2 words"]


def test_a_hot_title_is_folded_as_a_stream(spark):
    rows = [("i", 1, n, "Same", f"word{n} shared") for n in range(3000)]
    got = A.merge_same_titles(spark.createDataFrame(rows, "issue string, page int, ordinal int, title string, body string").withColumn("category", F.lit("c")))
    assert got.count() == 1 and got.first()["body"].count("\n\n") == 2999


