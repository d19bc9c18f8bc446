"""Operators that need Python: likest titles, word segmentation, tolerant JSON. Arrow-batched."""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from broadsheet.functions import text as X
from broadsheet.functions import vocabulary as V
from broadsheet.operators import folds
from broadsheet.operators.likeness import Title, likest


#: Rows of an issue that are compared in one place.
RUN = 256


def fuzzy_continuations(articles: DataFrame, look_back: int = V.FUZZY_LOOK_BACK, least: float = V.FUZZY_TITLE) -> DataFrame:
    """(issue, ordinal, target, score): each article's likest title among the look_back before it, by blocks or by words.

    An issue's titles are numbered in order and dealt out in runs, each with the last look_back
    titles before it; a run is a stream that holds look_back titles. So an issue of n articles makes at most
    look_back * n pairs, however few issues there are. Only the numbering sees an issue as a whole.
    """
    rows = max(RUN, look_back)
    keyed = articles.select("issue", "ordinal", X.label_key("title").alias("key")).filter("key <> ''")
    numbered = keyed.withColumn("n", F.row_number().over(Window.partitionBy("issue").orderBy("ordinal")) - 1).withColumn("home", F.expr(f"n div {rows}"))
    late = F.col("n") % rows >= rows - look_back
    dealt = numbered.withColumn("run", F.explode(F.when(late, F.array(F.col("home"), F.col("home") + 1)).otherwise(F.array("home"))))
    dealt = dealt.select("issue", "run", "n", "ordinal", "key", (F.col("run") == F.col("home")).alias("own"))
    kind = dealt.schema["ordinal"].dataType

    def start() -> Callable:
        before: deque[tuple[object, Title]] = deque(maxlen=look_back)

        def step(ordinal, key: str, own: bool) -> list[dict] | None:
            found = likest(key, [t for _, t in before], least) if own else ()
            out = [{"target": before[i][0], "score": score} for i, score in found]
            before.append((ordinal, Title(key)))
            return out or None

        return step

    found = T.StructField("found", T.ArrayType(T.StructType([T.StructField("target", kind), T.StructField("score", T.DoubleType())])))
    some = folds.fold(dealt, ["issue", "run"], ["n"], start, ["ordinal", "key", "own"], found, unread=["n", "key", "own"])
    scored = some.select("issue", "ordinal", F.explode("found").alias("e")).select("issue", "ordinal", "e.target", F.round("e.score", 4).alias("score"))
    best = scored.filter(F.col("score") >= least).groupBy("issue", "ordinal").agg(F.min(F.struct((-F.col("score")).alias("s"), "target")).alias("m"))
    return best.select("issue", "ordinal", "m.target", (-F.col("m.s")).alias("score"))


def parse_tolerant(text: str | None):
    """The first JSON value in a model's reply: thoughts dropped, fenced blocks first, then balanced parts."""
    text = re.sub(r"(?is)<think>.*?</think>", "", text or "")
    tries = [text, *re.findall(r"(?s)```(?:json)?\s*(.*?)```", text)]
    for part in tries:
        try:
            return json.loads(part)
        except ValueError:
            pass
    reader = json.JSONDecoder()
    for at in (m.start() for m in re.finditer(r"[\[{]", text)):
        try:
            return reader.raw_decode(text, at)[0]
        except ValueError:
            pass
    return None


def tolerant_json(text: Column) -> Column:
    """parse_tolerant as a column of JSON text, null where nothing parses."""

    @pandas_udf("string")
    def of(x: pd.Series) -> pd.Series:
        found = [parse_tolerant(t) for t in x]
        return pd.Series([None if f is None else json.dumps(f, ensure_ascii=False, sort_keys=True) for f in found], dtype=object)

    return of(text)


class Segmenter:
    """Splits glued words by a lexicon of word frequencies: the split of least cost, unknown parts dear by their length."""

    def __init__(self, lexicon: dict[str, int]):
        import math

        total = sum(lexicon.values()) or 1
        self.cost = {w: math.log(total / n) for w, n in lexicon.items() if n > 0}
        self.longest = max(map(len, self.cost), default=1)

    def split(self, text: str) -> list[str]:
        low, best, back = text.lower(), [0.0], [0]
        for i in range(1, len(low) + 1):
            options = [(best[j] + self.cost.get(low[j:i], 14.0 * (i - j)), j) for j in range(max(0, i - self.longest), i)]
            cost, j = min(options)
            best.append(cost)
            back.append(j)
        out, i = [], len(low)
        while i:
            out.append(text[back[i] : i])
            i = back[i]
        return out[::-1]


def repair_hyphens(text: Column, lexicon: dict[str, int]) -> Column:
    """Hyphens at line breaks: closed where the segmenter takes both parts for one word, else kept without the break."""
    segmenter = Segmenter(lexicon)

    @pandas_udf("string")
    def of(x: pd.Series) -> pd.Series:
        fix = lambda m: m[1] + m[2] if len(segmenter.split(m[1] + m[2])) == 1 else f"{m[1]}-{m[2]}"
        return pd.Series([None if t is None else re.sub(r"(\w+)-\s+(\w+)", fix, t) for t in x], dtype=object)

    return of(text)
