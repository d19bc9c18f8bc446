"""Folds over ordered rows, as Arrow streams: what is held is a group's state, never its rows.

Each decides row by row what a group's earlier rows allow, which neither a join nor a window can say.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from broadsheet.functions import text as X
from broadsheet.functions import vocabulary as V
from broadsheet.operators.likeness import Title, ratio_bounds

_TOKEN = re.compile("[a-z0-9]+")


def fold(rows: DataFrame, group: Sequence[str], order: Sequence[str], start: Callable[[], Callable], read: Sequence[str], out: T.StructField, unread: Sequence[str] = ()) -> DataFrame:
    """rows with a column ``out``: start() gives a group's step, which takes the values of ``read`` in order and gives the value.

    Columns in ``unread`` are not returned. Rows that tie in group and order come in no order of
    their own: order should tell them apart. Values that can't be told apart by hash are neighbours, so
    a group never mixes with another.
    """
    kept = [c for c in rows.columns if c not in unread]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartition(parts, *group).sortWithinPartitions(*group, *order)
    schema = T.StructType([*[sorted_.schema[c] for c in kept], out])
    kind = to_arrow_type(out.dataType)
    names, keys, values = rows.columns, list(group), list(read)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, step = None, None
        for batch in batches:
            column = {c: batch.column(names.index(c)) for c in {*names}}
            found = []
            of_keys = zip(*[column[c].to_pylist() for c in keys], strict=True) if keys else iter([()] * batch.num_rows)
            for key, value in zip(of_keys, zip(*[column[c].to_pylist() for c in values], strict=True), strict=True):
                if step is None or key != last:
                    last, step = key, start()
                found.append(step(*value))
            yield pa.record_batch([*[column[c] for c in kept], pa.array(found, kind)], names=[*kept, out.name])

    return sorted_.mapInArrow(run, schema)


def new_pieces(rows: DataFrame, group: Sequence[str], order: Sequence[str], overlap: float, body: str = "body", title: str | None = "title") -> DataFrame:
    """rows with piece: what a row adds to its group's text, null where that share of its tokens is there already.

    Another title than the first becomes a subheading. Joined in order the pieces are the text. A
    group's state is its set of tokens.
    """
    keyed = rows.withColumn("_label", X.label_key(F.coalesce(title, F.lit(""))) if title else F.lit("")).withColumn("_title", F.coalesce(title, F.lit("")) if title else F.lit(""))

    def start() -> Callable:
        known: set[str] = set()
        label, begun = None, False

        def step(text: str | None, own: str, name: str) -> str | None:
            nonlocal label, begun
            label = own if label is None else label
            if not text:
                return None
            found = _TOKEN.findall(text.lower())
            if not begun:
                begun = True
                known.update(found)
                return text
            if (sum(t in known for t in found) / len(found) if found else 0.0) >= overlap:
                return None
            head = f"\n\n### {name}" if own != label and name else ""
            known.update(found, _TOKEN.findall(head.lower()))
            return f"{head}\n\n{text}"

        return step

    return fold(keyed, group, order, start, [body, "_label", "_title"], T.StructField("piece", T.StringType()), unread=["_label", "_title", body])


def joined_pieces(order: Sequence[str]) -> Column:
    """The text of a group of pieces, as an aggregate."""
    pieces = F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct(*order, "piece"))))
    return F.array_join(F.transform(pieces, lambda p: p["piece"]), "")


def overlaps_before(rows: DataFrame, group: Sequence[str], order: Sequence[str], body: str = "body") -> DataFrame:
    """rows without body, with overlap: the share of a body's tokens that the row before it in the group has; null where that has no body.

    A body is cut into tokens once, and not at all where it is alone in its group. A group's state is the
    last row's text or tokens, so a row costs its own length, whatever stands before it.
    """
    lowered = rows.withColumn("_lower", F.lower(body))

    def start() -> Callable:
        text_before: str | None = None
        before: set[str] | None = None

        def step(text: str | None) -> float | None:
            nonlocal text_before, before
            if text_before is None:
                text_before, before = text, None
                return None
            found = _TOKEN.findall(text or "")
            known = set(_TOKEN.findall(text_before)) if before is None else before
            text_before, before = text, set(found)
            return sum(t in known for t in found) / len(found) if found else 0.0

        return step

    return fold(lowered.drop(body), group, order, start, ["_lower"], T.StructField("overlap", T.DoubleType()), unread=["_lower"])


def continuation_targets(articles: DataFrame, look_back: int = V.FUZZY_LOOK_BACK, similarity: float = V.FUZZY_TITLE) -> DataFrame:
    """articles with target: the ordinal of the article that a row continues, its own where it continues none.

    Rows of an issue by page and ordinal. A row continues the latest one of the same title on another
    page; else, if it is marked as continued (columns is_continuation, continuation_of or its title), of
    the last ``look_back`` kept ones the first of that title or the most alike. Only titles are read:
    an issue's state is a list of them.
    """
    names = articles.columns
    said = F.coalesce(F.col("continuation_of"), F.lit("")) if "continuation_of" in names else F.lit("")
    said = X.strip(said)
    title = X.strip(F.coalesce("title", F.lit("")))
    flag = F.coalesce(F.col("is_continuation"), F.lit(False)) if "is_continuation" in names else F.lit(False)
    marked = flag | (said != "") | X.is_continued(title)
    base = X.continued_base(F.when(said != "", said).otherwise(title))
    light = articles.select("issue", "page", "ordinal", X.label_key(title).alias("_own"), X.label_key(base).alias("_base"), marked.cast("int").alias("_marked"))

    def start() -> Callable:
        kept: list[tuple[str, object, int]] = []
        titles: dict[int, Title] = {}
        pages: dict[str, list[int]] = {}

        def alike(key: str) -> int | None:
            words, best = frozenset(key.split()), None
            near = range(max(0, len(kept) - look_back), len(kept))
            for i in near:
                other = kept[i][0]
                if not other:
                    continue
                if other == key:
                    return i
                if i not in titles:
                    titles[i] = Title(other)
                shared = titles[i].shared(words)
                longest = 2 * min(len(key), len(other)) / (len(key) + len(other))
                if shared < similarity and (longest < similarity or ratio_bounds(key, [titles[i]])[0] < similarity):
                    continue
                score = max(titles[i].ratio(key), shared)
                if score >= similarity and (best is None or score > best[0]):
                    best = (score, i)
            for i in [i for i in titles if i not in near]:
                del titles[i]
            return best and best[1]

        def step(page, ordinal: int, own: str, base: str, marked: int) -> int:
            at = next((i for i in reversed(pages.get(own, ())) if kept[i][1] != page), None) if own else None
            if at is None and marked and base:
                at = alike(base)
            if at is not None:
                return kept[at][2]
            key = (base or own) if marked else own
            pages.setdefault(key, []).append(len(kept))
            kept.append((key, page, ordinal))
            return ordinal

        return step

    found = fold(light, ["issue"], ["page", "ordinal"], start, ["page", "ordinal", "_own", "_base", "_marked"], T.StructField("target", T.LongType()), unread=["_own", "_base", "_marked"])
    return articles.join(found, ["issue", "page", "ordinal"])


def free_names(rows: DataFrame, group: Sequence[str], base: str, order: str, alias: str = "name", joint: str = "_") -> DataFrame:
    """rows with a name each that no earlier row of the group has: base, else base_2, base_3 and so on, the first that is free."""

    def start() -> Callable:
        used: set[str] = set()
        tried: dict[str, int] = {}

        def step(name: str) -> str:
            found, n = name, tried.get(name, 2)
            while found in used:
                found, n = f"{name}{joint}{n}", n + 1
            tried[name] = n
            used.add(found)
            return found

        return step

    return fold(rows, group, [order], start, [base], T.StructField(alias, T.StringType()))


def without_module(lines: DataFrame, module: DataFrame, ratio: float = 0.9, least: int = 18) -> DataFrame:
    """Lines of pages (page, line_no, line) without those of a module cut from them (page, line), each as often as the module has it.

    A line of ``least`` characters or more also goes with a module line of like length that is that
    much alike, the first one left. White space counts as one space. The module of a page travels with
    each of the page's lines: it is a few lines, whatever the page.
    """
    of_page = module.select("page", X.squeeze(F.col("line")).alias("l")).filter("l <> ''").groupBy("page").agg(F.array_sort(F.collect_list("l")).alias("_module"))
    rows = lines.join(of_page, "page", "left").withColumn("_flat", X.squeeze(F.coalesce("line", F.lit(""))))

    def start() -> Callable:
        left: dict[str, int] | None = None

        def step(flat: str, lines_of: list[str] | None) -> str | None:
            nonlocal left
            if left is None:
                left = {}
                for line in lines_of or ():
                    left[line] = left.get(line, 0) + 1
            hit = flat if left.get(flat) else None
            if hit is None and len(flat) >= least:
                near = (c for c, n in left.items() if n > 0 and abs(len(c) - len(flat)) <= max(8, len(c) // 5))
                hit = next((c for c in near if SequenceMatcher(None, flat, c).ratio() >= ratio), None)
            if hit is None:
                return None
            left[hit] -= 1
            return hit

        return step

    marked = fold(rows, ["page"], ["line_no"], start, ["_flat", "_module"], T.StructField("_hit", T.StringType()), unread=["_flat", "_module"])
    return marked.filter("_hit is null").select(*lines.columns)
