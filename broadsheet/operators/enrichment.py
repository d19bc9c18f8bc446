"""Calls to outside models: interfaces only, with a client that answers nothing by default.

A client is anything with ``complete(task, payload) -> dict | None``. No address is built in. Calls run
where the rows are; the number of partitions bounds how many are in flight.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions import text as X


class ModelClient(Protocol):
    def complete(self, task: str, payload: dict) -> dict | None: ...


class NullClient:
    """Answers nothing, so that every step falls back."""

    def complete(self, task: str, payload: dict) -> dict | None:
        return None


class RetryingClient:
    """Tries clients in order, each a few times with growing waits; a refusal (None) isn't tried again."""

    def __init__(self, clients: list[ModelClient], tries: int = 3, wait: float = 1.0, most: float = 8.0):
        self.clients, self.tries, self.wait, self.most = clients, tries, wait, most

    def complete(self, task: str, payload: dict) -> dict | None:
        error: Exception | None = None
        for client in self.clients:
            for n in range(self.tries):
                try:
                    return client.complete(task, payload)
                except (OSError, TimeoutError, ValueError) as e:
                    error = e
                    time.sleep(min(self.most, self.wait * 2**n))
        if error:
            raise error
        return None


def call(rows: DataFrame, task: str, payload: list[str], client: ModelClient | None = None, in_flight: int = 3) -> DataFrame:
    """rows with reply (JSON text, or null) and reply_error of a call for each."""
    client = client or NullClient()
    schema = T.StructType([*rows.schema.fields, T.StructField("reply", T.StringType()), T.StructField("reply_error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            replies, errors = [], []
            for p in f[payload].to_dict("records"):
                try:
                    found = client.complete(task, p)
                    replies.append(None if found is None else json.dumps(found, ensure_ascii=False))
                    errors.append(None)
                except Exception as e:  # one row's failure is data: it is retried later
                    replies.append(None)
                    errors.append(str(e)[:220])
            yield f.assign(reply=pd.Series(replies, index=f.index, dtype=object), reply_error=pd.Series(errors, index=f.index, dtype=object))

    return rows.repartition(in_flight).mapInPandas(run, schema)


def accept_longer(old: Column, new: Column) -> Column:
    """A repaired body counts only if it is longer."""
    return F.when(F.length(F.coalesce(new, F.lit(""))) > F.length(F.coalesce(old, F.lit(""))), new).otherwise(old)


def accept_translation(source: Column, translated: Column) -> Column:
    """A list of paragraphs counts only if there is one for each."""
    return F.when(F.size(source) == F.size(translated), translated)


def accept_summary(text: Column) -> Column:
    """Whether a summary is in the style asked for: three to five paragraphs of prose, no sentence over 90 characters of CJK."""
    parts = X.paragraphs(text)
    listed = F.exists(parts, lambda p: p.rlike("^(?:#{1,6} |[-*+] |[0-9]+[.\u3001)])"))
    longest = F.array_max(F.transform(X.cjk_sentences(text), X.cjk_count))
    return F.size(parts).between(3, 5) & ~listed & (F.coalesce(longest, F.lit(0)) <= 90)


def alternatives(reply: Column, *keys: str) -> Column:
    """The first of several keys that a JSON object has."""
    return F.coalesce(*[F.get_json_object(reply, f"$.{k}") for k in keys])


def text_of_reply(reply: Column) -> Column:
    """The text of a reply, whatever the shape: message content, tool arguments, choice text or plain output."""
    return alternatives(reply, "choices[0].message.content", "choices[0].message.tool_calls[0].function.arguments", "choices[0].text", "message.content", "output[0].content[0].text", "content[0].text", "output_text", "text")


def native_split(pages: DataFrame, blocks: DataFrame, client: ModelClient | None = None, in_flight: int = 3) -> DataFrame:
    """(page, article, title, category, body, block_ids): a model names the blocks of each article, their text is put together here.

    pages: page and prompt. Accepted are articles with a title and a block that the page has; a page
    without one is missing from the result, so that it falls back.
    """
    from broadsheet.operators import pages as P

    kind = "array<struct<title string, category string, content_block_ids array<string>>>"
    asked = call(pages.select("page", "prompt"), "native_split", ["prompt"], client, in_flight)
    found = asked.select("page", F.posexplode(F.from_json(F.get_json_object("reply", "$.articles"), kind)).alias("article", "a"))
    named = found.select("page", F.col("article").cast("long").alias("article"), F.trim("a.title").alias("title"), "a.category", F.col("a.content_block_ids").alias("block_ids")).filter("title <> ''")
    bodies = P.assemble(named.select("page", "article", "block_ids"), blocks)
    return named.drop("block_ids").join(bodies, ["page", "article"]).select("page", "article", "title", "category", "body", "block_ids")


def anchor_split(pages: DataFrame, client: ModelClient | None = None, in_flight: int = 3) -> DataFrame:
    """(page, article, title, category, body, how): a model names first and last words of each article, the page's text between them is the body.

    pages: page, text, prompt. Where the anchors aren't found in order the body is the anchors themselves.
    """
    from broadsheet.operators import articles as A

    kind = "array<struct<title string, category string, start_anchor string, end_anchor string>>"
    asked = call(pages.select("page", "text", "prompt"), "anchor_split", ["prompt"], client, in_flight)
    found = asked.select("page", "text", F.posexplode(F.from_json(F.get_json_object("reply", "$.articles"), kind)).alias("article", "a"))
    sliced = X.anchor_slice(F.col("text"), F.coalesce("a.start_anchor", F.lit("")), F.coalesce("a.end_anchor", F.lit("")))
    body = F.coalesce(sliced, A.fallback_body(F.col("a.start_anchor"), F.col("a.end_anchor")))
    rows = found.select("page", F.col("article").cast("long").alias("article"), F.trim("a.title").alias("title"), "a.category", body.alias("body"), F.when(sliced.isNotNull(), "slice").otherwise("anchors").alias("how"))
    return rows.filter((F.col("title") != "") & (F.col("body") != "..."))


def vision_articles(pages: DataFrame, client: ModelClient | None = None, in_flight: int = 3) -> DataFrame:
    """(page, article, title, category, body): articles that a model reads off a page's image. Accepted are those with a title and a body.

    pages: page and image (bytes), which go to the client as they are.
    """
    kind = "array<struct<title string, category string, content_markdown string>>"
    asked = call(pages.select("page", "image"), "vision_articles", ["image"], client, in_flight)
    found = asked.select("page", F.posexplode(F.from_json(F.get_json_object("reply", "$.articles"), kind)).alias("article", "a"))
    rows = found.select("page", F.col("article").cast("long").alias("article"), F.trim("a.title").alias("title"), "a.category", X.strip(F.coalesce("a.content_markdown", F.lit(""))).alias("body"))
    return rows.filter((F.col("title") != "") & (F.col("body") != ""))


def image_insights(articles: DataFrame, client: ModelClient | None = None, in_flight: int = 3) -> DataFrame:
    """articles (id, title, body, images) with images, image_insights and image_analysis_complete after a model has looked at them.

    Articles without images are not asked about; where the reply reviews none of an article's images, it stays as it is.
    """
    from broadsheet.operators import images as I

    rows = articles.withColumn("_usable", I.capped(F.col("images"))).withColumn("_context", F.left(F.coalesce("body", F.lit("")), F.lit(4500)))
    asked = call(rows.filter(F.size("_usable") > 0).select("id", F.col("title").alias("_title"), "_context", F.to_json("_usable").alias("_paths")), "image_insights", ["_title", "_context", "_paths"], client, in_flight)
    joined = rows.join(asked.select("id", "reply"), "id", "left").withColumn("_r", I.insights_of_reply(F.col("reply"), F.col("_usable")))
    done = F.coalesce(F.col("_r.reviewed") > 0, F.lit(False))
    new = [F.when(done, F.col("_r.insights.path")).otherwise(F.col("images")).alias("images"), F.when(done, F.col("_r.insights")).alias("image_insights"), done.alias("image_analysis_complete")]
    return joined.select(*[c for c in articles.columns if c not in ("images", "image_insights", "image_analysis_complete")], *new)


class DowngradingClient:
    """Sends options along with a payload and drops, or renames, those that a model says it doesn't support.

    client.complete takes the payload with the key options. An error that names an option and says
    unsupported, unknown or unrecognized is taken for that; any other goes on to the caller.
    """

    #: What an option is sent as instead; the others are left out.
    RENAMED = {"max_tokens": "max_completion_tokens"}

    def __init__(self, client: ModelClient, options: dict):
        self.client, self.options = client, options

    def complete(self, task: str, payload: dict) -> dict | None:
        options = dict(self.options)
        while True:
            try:
                return self.client.complete(task, payload | {"options": options})
            except Exception as e:
                said = str(e).lower()
                odd = next((k for k in options if k.lower() in said), None)
                if odd is None or not any(w in said for w in ("unsupported", "not supported", "unknown", "unrecognized", "unexpected")):
                    raise
                value = options.pop(odd)
                if odd in self.RENAMED:
                    options[self.RENAMED[odd]] = value
