"""String and token functions, as Column expressions.

Patterns name their character classes outright, since \\w and \\s differ between regex engines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.vocabulary import STOP_WORDS

WORD = "[A-Za-z0-9]+(?:[\\x27-][A-Za-z0-9]+)?"
TOKEN = "[a-z0-9]+"
CJK = "[\\u3400-\\u4dbf\\u4e00-\\u9fff]"


def once(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with value worked out once however often of uses it: a lambda's argument is bound."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def or_else(value: Column, default: Column) -> Column:
    """default where a string is null or blank."""
    return F.when(F.length(F.trim(F.coalesce(value, F.lit("")))) > 0, value).otherwise(default)


def to_int(value: Column, default: int | None = None) -> Column:
    """An integer in a string, else default."""
    return F.coalesce(F.trim(value.cast("string")).try_cast("int"), F.lit(default).cast("int"))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, "^[ \\t-\\r]+|[ \\t-\\r]+$", "")


def squeeze(text: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, "[ \\t-\\r]+", " "))


def flatten_lines(text: Column) -> Column:
    return strip(F.regexp_replace(text, "[ \\t-\\r]*\\n[ \\t-\\r]*", " "))


def label_key(text: Column) -> Column:
    """Lower case, one space for whatever is neither letter nor digit."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def heading_key(text: Column) -> Column:
    """label_key with the two common ligatures spelled out."""
    return label_key(F.replace(F.replace(text, F.lit("\ufb01"), F.lit("fi")), F.lit("\ufb02"), F.lit("fl")))


def slug(text: Column, default: str, most: int | None = None, joint: str = "-") -> Column:
    key = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", joint)
    key = F.regexp_replace(key, f"^{joint}+|{joint}+$", "")
    key = F.left(key, F.lit(most)) if most else key
    return or_else(key, F.lit(default))


def safe_title(text: Column, most: int = 30, default: str = "Article") -> Column:
    """A title fit for a file name: letters, digits, space, low line and hyphen."""
    kept = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\p{L}\\p{N} _-]", ""))
    return or_else(F.trim(F.left(kept, F.lit(most))), F.lit(default))


def safe_stem(text: Column, most: int = 80) -> Column:
    return F.left(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), F.lit(most))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def link_tokens(text: Column) -> Column:
    """Distinct tokens for linking: hyphens at breaks closed, short and stop words dropped, plurals made singular."""
    joined = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "([a-z])-[ \\t-\\r]+([a-z])", "$1$2")
    found = F.filter(F.regexp_extract_all(joined, F.lit(TOKEN), F.lit(0)), lambda t: (F.length(t) >= 3) & ~t.isin(*STOP_WORDS))

    def singular(t: Column) -> Column:
        long = F.length(t) > 4
        return F.when(long & t.endswith("ies"), F.regexp_replace(t, "ies$", "y")).when(long & t.endswith("s") & ~t.endswith("ss"), F.regexp_replace(t, "s$", "")).otherwise(t)

    return F.array_distinct(F.transform(found, singular))


SUMMARY_TOKEN = "[a-z0-9]+(?:[\\x27-][a-z0-9]+)?"


def summary_text(text: Column) -> Column:
    """Lower case, without page labels such as A12."""
    return F.lower(F.regexp_replace(text, "(?i)(?<![A-Z0-9])[A-Z][0-9]{1,3}(?![A-Z0-9])", " "))


def summary_tokens(text: Column) -> Column:
    """Tokens without page labels; a bag, repeats kept."""
    return F.regexp_extract_all(summary_text(text), F.lit(SUMMARY_TOKEN), F.lit(0))


def paragraphs(text: Column) -> Column:
    """Parts between blank lines, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text, "\\n[ \\t-\\r]*\\n"), strip), lambda p: F.length(p) > 0)


def lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\\n"), strip), lambda p: F.length(p) > 0)


def containment(a: Column, b: Column) -> Column:
    """Share of the tokens of bag a that set b has; 0 for an empty bag. Both are worked out once, not for each token."""

    def share(s: Column) -> Column:
        hits = F.size(F.filter(s["a"], lambda t: F.array_contains(s["b"], t)))
        return F.when(F.size(s["a"]) > 0, hits / F.greatest(F.size(s["a"]), F.lit(1))).otherwise(0.0)

    return once(F.struct(a.alias("a"), F.array_distinct(b).alias("b")), share)


def spaced_letters(text: Column) -> Column:
    """Joins runs of four or more single letters: H E A D becomes HEAD."""
    parts = F.split(F.regexp_replace(text, "\\b((?:[A-Za-z][ \\t-\\r]+){3,}[A-Za-z])\\b", "\u0001$1\u0001"), "\u0001")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.regexp_replace(p, "[ \\t-\\r]+", "")).otherwise(p)), "")


def without_turns(text: Column) -> Column:
    """Drops turn-to and continued-from references."""
    bare = F.regexp_replace(text, "(?i)\\b(?:please[ \\t-\\r]*)?turn[ \\t-\\r]*to[ \\t-\\r]*page[ \\t-\\r]*[A-Z]?[0-9]+\\b", "")
    return F.regexp_replace(bare, "(?i)\\bcontinued[ \\t-\\r]*from[ \\t-\\r]*page[ \\t-\\r]*(?:one|[A-Z]?[0-9]+)\\b", "")


def sentences(text: Column) -> Column:
    """Parts after an end mark and before a capital or a quote."""
    return F.split(text, "(?<=[.!?\u3002\uff01\uff1f])[ \\t-\\r]+(?=[A-Z\u201c\u2018\"\\x27])")


def sentence_pack(parts: Column, least: int = 90) -> Column:
    """Greedy packing of sentences to paragraphs of at least so many words, a shorter rest last."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("cur"), F.lit(0).alias("n"))

    def add(s: Column, p: Column) -> Column:
        n = s["n"] + F.size(F.filter(F.split(p, "[ \\t-\\r]+"), lambda w: F.length(w) > 0))
        cur = F.array_append(s["cur"], p)
        full = n >= least
        out = F.when(full, F.array_append(s["out"], F.array_join(cur, " "))).otherwise(s["out"])
        return F.struct(out.alias("out"), F.when(full, F.array().cast("array<string>")).otherwise(cur).alias("cur"), F.when(full, F.lit(0)).otherwise(n).alias("n"))

    def finish(s: Column) -> Column:
        return F.when(F.size(s["cur"]) > 0, F.array_append(s["out"], F.array_join(s["cur"], " "))).otherwise(s["out"])

    return F.aggregate(parts, start, add, finish)


def clean_paragraphs(text: Column, repair=None) -> Column:
    """The cleanup chain: letters joined, references dropped, hyphens repaired, sentences packed.

    repair: an optional function of a text column that decides hyphens at line breaks; without one
    the hyphen stays and the break goes.
    """
    bare = without_turns(spaced_letters(text))
    bare = repair(bare) if repair else F.regexp_replace(bare, "([\\p{L}\\p{N}_]+)-[ \\t-\\r]+([\\p{L}\\p{N}_]+)", "$1-$2")
    return sentence_pack(sentences(squeeze(bare)))


def end_mark(text: Column) -> Column:
    """Drops a lone B that ends an article."""
    return F.regexp_replace(text, "[ \\t-\\r]+B[ \\t-\\r]*$", "")


def anchor_slice(text: Column, start: Column, end: Column) -> Column:
    """Text from the first place of start's first 20 characters to the end of end's last 20; null without both."""
    flat, head, tail = squeeze(text), F.left(squeeze(start), F.lit(20)), F.right(squeeze(end), F.lit(20))
    begin = F.instr(flat, head)
    after = F.call_function("locate", tail, flat, begin)
    found = (begin > 0) & (after > 0) & (F.length(head) > 0) & (F.length(tail) > 0)
    return F.when(found, F.substring(flat, begin, after - begin + F.length(tail)))


def markdown_sections(text: Column) -> Column:
    """array of struct(title, body) of a Markdown text by headings of one to three marks."""
    marked = F.regexp_replace(text, "(?m)^(#{1,3} )", "\u0001$1")
    parts = F.filter(F.split(marked, "\u0001"), lambda p: p.rlike("^#{1,3} "))
    return F.transform(parts, lambda p: F.struct(strip(F.regexp_replace(F.substring_index(p, "\n", 1), "^#{1,3} ", "")).alias("title"), strip(F.substring(p, F.instr(F.concat(p, F.lit("\n")), "\n") + 1, F.length(p))).alias("body")))


def strip_tags(html: Column) -> Column:
    return squeeze(F.regexp_replace(html, "<[^>]*>", " "))


def escape_html(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def rewrite_image_paths(text: Column, root: str = "../images/") -> Column:
    """Points Markdown and src references to images at another root."""
    out = F.replace(text, F.lit("(images/"), F.lit(f"({root}"))
    return F.regexp_replace(out, "(src=[\"\\x27])images/", f"$1{root}")


def display_name(file_name: Column) -> Column:
    """A file name without a leading part in brackets and without its ending."""
    return F.regexp_replace(F.regexp_replace(file_name, "^[ ]*\\[[^\\]]*\\][ ]*", ""), "\\.pdf$", "")


def cjk_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(CJK), F.lit(0))).cast("long")


def cjk_sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "[\u3002\uff01\uff1f!?]+"), F.trim), lambda s: F.length(s) > 0)


def compact_error(text: Column, most: int = 220) -> Column:
    flat = squeeze(text)
    return F.when(F.length(flat) > most, F.concat(F.left(flat, F.lit(most - 3)), F.lit("..."))).otherwise(flat)


def truncate_at_sentence(text: Column, least: int = 100, most: int = 200) -> Column:
    """Text up to its last full sentence within most characters if that has at least so many, else cut with an ellipsis."""
    cut = F.regexp_replace(F.left(text, F.lit(most)), "[\u3002\uff01\uff1f]", "\u3002")
    at = F.instr(F.reverse(cut), "\u3002")
    end = F.length(cut) - at + 1
    short = F.regexp_replace(F.left(text, F.lit(most - 1)), "[\uff0c,\uff1b;\uff1a: ]+$", "")
    return F.when(F.length(text) <= most, text).when((at > 0) & (end >= least), F.left(text, end)).otherwise(F.concat(short, F.lit("\u2026")))


def clean_inline(text: Column) -> Column:
    """One line without Markdown marks at its ends."""
    return F.regexp_replace(squeeze(F.coalesce(text, F.lit(""))), "^[`*_#]+|[`*_#]+$", "")


def clean_description(text: Column) -> Column:
    return F.translate(squeeze(F.coalesce(text, F.lit(""))), "\"'", "\u300c\u2019")


def english_in_cjk(text: Column, most: int) -> Column:
    """Names in Latin letters within Chinese text: the first ``most``, case aside once each."""
    word = "[A-Za-z][A-Za-z0-9]*(?:[.\x27\u2019_-][A-Za-z0-9]+)*"
    more = "(?:(?:[ \\t]+|,[ \\t-\\r]*)[A-Za-z&][A-Za-z0-9]*(?:[.\x27\u2019_-][A-Za-z0-9]+)*){0,7}"
    found = F.regexp_extract_all(text, F.lit(f"(?<![A-Za-z0-9_])({word}{more})(?![A-Za-z0-9_])"), F.lit(1))
    named = F.filter(F.transform(found, lambda x: F.regexp_replace(clean_inline(x), "^[ ,.;:!?()\\[\\]{}]+|[ ,.;:!?()\\[\\]{}]+$", "")), lambda x: (F.length(x) >= 2) & ~x.rlike("^[a-z][a-z-]*$") & x.rlike("[A-Z0-9.]"))
    return F.slice(F.filter(named, lambda x, i: F.array_position(F.transform(named, F.lower), F.lower(x)) == i + 1), 1, most)


def continued_base(title: Column) -> Column:
    """A title without its mark of continuation, at its end or before it."""
    out = F.regexp_replace(title, "(?i)[ \\t-\\r]*\\(?[ \\t-\\r]*continued[ \\t-\\r]*\\)?[ \\t-\\r]*$", "")
    out = F.regexp_replace(out, "(?i)^continued[ \\t-\\r]*[:-][ \\t-\\r]*", "")
    return F.when(out == title, squeeze(title)).otherwise(squeeze(F.regexp_replace(out, "[ \\t-\\r]*[-\u2013\u2014:][ \\t-\\r]*$", "")))


def is_continued(title: Column) -> Column:
    return title.rlike("(?i)\\bcontinued\\b")


def occurrences(text: Column, term: str) -> Column:
    """All case-insensitive places of a literal term between ASCII word borders, as written there."""
    import re

    quoted = re.sub(r"([^A-Za-z0-9 ])", r"\\\1", term)
    return F.regexp_extract_all(text, F.lit(f"(?i)(?<![A-Za-z0-9])({quoted})(?![A-Za-z0-9])"), F.lit(1))


def guess_title(text: Column, least: int = 8, most: int = 120) -> Column:
    return F.left(F.get(F.filter(lines(text), lambda x: F.length(x) >= least), F.lit(0)), F.lit(most))


def first_literal(text: Column, choices: Sequence[str]) -> Column:
    """The longest of the choices that stands in an upper-case text between letters' borders; spaces around & don't count."""
    import re

    near = F.regexp_replace(text, " *& *", "&")
    out = None
    for choice in sorted(choices, key=len, reverse=True):
        needle = re.sub(r"([^A-Za-z0-9 ])", r"\\\1", re.sub(r"\s*&\s*", "&", choice.upper()))
        hit = near.rlike(f"(?<![A-Z]){needle}(?![A-Z])")
        out = F.when(hit, F.lit(choice)) if out is None else out.when(hit, F.lit(choice))
    return out
