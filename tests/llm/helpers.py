"""Small tables with what real ones hold: nulls, empty and long texts, ties, repeats and clashing columns."""

import random

LANGS = {"en": "the of and ing tion re ed er th wh".split(), "de": "der die und sch ein ung keit ich zu ge".split(), "fr": "le la et que eau ai oi ment pas une".split()}


def words(rng, lang, n):
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(spark, n=60, seed=1, extra=True):
    """(doc_id, text, lang, source, n_chars) and columns whose names operators use inside."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(LANGS))
        text = "\n".join(words(rng, lang, rng.randint(5, 60)) + "." for _ in range(rng.randint(1, 6)))
        rows.append((i, text, lang, rng.choice(["a", "a", "b", None])))
    rows[3] = (3, None, "en", "a")
    rows[4] = (4, "", None, "b")
    rows[5] = (5, rows[6][1], rows[6][2], "a")
    rows[7] = (7, rows[6][1].replace(".", ","), rows[6][2], "b")
    rows[8] = (8, words(rng, "en", 9000), "en", "a")
    rows[9] = (9, "日本語のテキスト🙂 12", None, "b")
    rows[10] = (10, " \t\n\r ", "en", "a")
    rows[11] = rows[12]
    rows.append(rows[13])
    rows.append((None, "a row without an id but with words", "en", "a"))
    kind = "doc_id long, text string, lang string, source string"
    if not extra:
        return spark.createDataFrame(rows, kind)
    more = "fp long, _h string, h int, key string, doc string, shard int, slot int, _of string, id int, run int"
    return spark.createDataFrame([(*r, 1, "x", 2, "k", "d", 3, 4, "o", 5, 6) for r in rows], f"{kind}, {more}")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
