"""Document fingerprints from closed syncmers, in DataFrame operations only.

A window of k characters is a closed syncmer if the least hash of the windows of s characters inside
it stands first or last. That depends on nothing outside, so equal passages have equal anchors
wherever they stand, in any script, spaced or not. Every anchor is kept, with its position; texts are
matched by positions, and the fingerprint is a digest of all of them.

``syncmers`` reads characters and is what the report uses. ``anchors`` reads coarser letters, for
spaced text at a quarter of the work: pieces of up to four characters of a run between ASCII white
space, single characters in runs of more than RUN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import cut

PIECE = "[^\\x20\\x09-\\x0D]{1,4}"
#: A run of non-blanks; those of more than RUN characters are read by single ones.
WHOLE, RUN = "[^\\x20\\x09-\\x0D]+", 16
LONG = f"[^\\x20\\x09-\\x0D]{{{RUN + 1}}}"
K, S = 6, 2
ANCHORS = "array<struct<at:int,h:int>>"


def _short(*of: Column) -> Column:
    """The upper 32 bits of a hash."""
    return F.shiftright(F.xxhash64(*of), 32).cast("int")


def letters(text: Column) -> Column:
    """The letters of a text, in order."""
    text = F.coalesce(text, F.lit(""))
    pieces = lambda x: F.regexp_extract_all(x, F.lit(PIECE), F.lit(0))
    run = lambda x: F.when(F.length(x) > RUN, F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))).otherwise(pieces(x))
    return F.when(text.rlike(LONG), F.flatten(F.transform(F.regexp_extract_all(text, F.lit(WHOLE), F.lit(0)), run))).otherwise(pieces(text))


def anchors(text: Column) -> Column:
    """All closed syncmers of a text as structs (at, h), in order: the number of the first letter, from 0, and a hash of 32 bits.

    A text of fewer than K letters has one, of all its letters; one without any has none.
    """
    width = K - S  # the inner windows of the K letters from i on are i .. i + width
    kind = ANCHORS

    def chosen(h: Column) -> Column:
        def anchor(x: Column, i: Column) -> Column:
            last = F.get(h, i + width)
            closed = last.isNotNull() & (F.least(x, last) <= F.least(*[F.get(h, i + j) for j in range(1, width)]))
            return F.when(closed, F.struct(i.alias("at"), _short(*[F.get(h, i + j) for j in range(0, width + 1, S)]).alias("h")))  # every other inner window covers all letters

        return F.array_compact(F.transform(h, anchor))

    def of(pieces: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(0), F.size(pieces) - S), lambda i: F.xxhash64(*[F.get(pieces, i + j) for j in range(S)]))
        many = F.get(F.transform(F.array(inner), chosen), F.lit(0))
        few = F.array(F.struct(F.lit(0).alias("at"), _short(F.concat_ws(" ", pieces)).alias("h")))
        return F.when(F.size(pieces) >= K, many.cast(kind)).when(F.size(pieces) > 0, few.cast(kind)).otherwise(F.array().cast(kind))

    # What a lambda binds is worked out once, so arrays that are used often are walked as an array's only element.
    return F.get(F.transform(F.array(letters(text)), of), F.lit(0))


def hashes_of(found: Column) -> Column:
    """Hashes of anchors, sorted and distinct."""
    return F.sort_array(F.array_distinct(found["h"]))


def syncmer_hashes(text: Column) -> Column:
    """Hashes (32 bits) of the closed syncmers of a text, sorted and distinct."""
    return hashes_of(anchors(text))


def matches(a: Column, b: Column) -> Column:
    """Positions (at, other) where anchors of a and of b are the same, by a and then b.

    The n-th anchor of a hash in one goes with the n-th in the other. One sort, no pairs are tried.
    """

    def ranked(found: Column, side: int) -> Column:
        def numbered(y: Column) -> Column:
            begins = F.array_compact(F.transform(y, lambda x, i: F.when((i == 0) | (F.get(y, i - 1)["h"] != x["h"]), i)))

            def split(s: Column) -> Column:
                end = lambda j: F.coalesce(F.get(s, j + 1), F.size(y))
                one = lambda x, n: F.struct(x["h"].alias("h"), n.alias("n"), F.lit(side).alias("side"), x["at"].alias("at"))
                return F.flatten(F.transform(s, lambda b, j: F.transform(F.slice(y, b + 1, end(j) - b), one)))

            return F.get(F.transform(F.array(begins), split), F.lit(0))

        by = F.sort_array(F.transform(found, lambda x: F.struct(x["h"].alias("h"), x["at"].alias("at"))))
        return F.get(F.transform(F.array(by), numbered), F.lit(0))

    def met(all_: Column) -> Column:
        def pair(x: Column, i: Column) -> Column:
            next_ = F.get(all_, i + 1)
            same = (x["side"] == 0) & (next_["side"] == 1) & (next_["h"] == x["h"]) & (next_["n"] == x["n"])
            return F.when(same, F.struct(x["at"].alias("at"), next_["at"].alias("other")))

        return F.sort_array(F.array_compact(F.transform(all_, pair)))

    return F.get(F.transform(F.array(F.sort_array(F.concat(ranked(a, 0), ranked(b, 1)))), met), F.lit(0))


def likeness(a: Column, b: Column, both: Column) -> Column:
    """Number of matches as a share of all anchors of both texts, by their numbers, matched ones counted once; two texts without an anchor are alike."""
    return F.when(a + b == 0, F.lit(1.0)).otherwise(both / F.greatest(a + b - both, F.lit(1)))


def digest(found: Column) -> Column:
    """SHA-256 of the hashes of all anchors in order, so equal where the texts have equal anchors in equal order."""
    return F.sha2(F.array_join(found["h"].cast("array<string>"), ","), 256)


def bound(value: Column, of) -> Column:
    """of(value), with value worked out once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


#: Characters of a window and of the windows inside it: about one window in nine is an anchor.
LONG_K, LONG_S = 24, 6
#: Windows that are worked out together: what a row holds besides its anchors doesn't follow its text.
BLOCK = 1 << 14


def _closed(text: Column, k: int, s: int) -> Column:
    """Closed syncmers (at, h) of a text; none if it has fewer than k characters.

    A window's least hash stands first, or last, if that is no more than the ``width`` hashes after,
    or before, it. A stretch of half that many, next to a hash's own stretch, lies within reach on
    either side: only a hash that is no more than the least of one of the two is looked at closely.
    """
    width = k - s
    half = max(width // 2, 1)
    cut_out = lambda code, at, n: F.substring(code, at * 4 + 1, F.lit(4 * n))

    def all_of(conditions: list[Column]) -> Column:
        out = conditions[0]
        for c in conditions[1:]:
            out = out & c
        return out

    def candidates(h: Column, least: Column) -> Column:
        def stretch(x: Column, b: Column) -> Column:
            inside = lambda t: F.filter(F.sequence(b * half, F.least(b * half + (half - 1), F.size(h) - 1)), lambda p: F.get(h, p) <= t)
            beside = F.greatest(F.get(least, b + 1), F.get(least, b - 1))
            return F.when(x <= beside, bound(beside, inside))

        return F.flatten(F.array_compact(F.transform(least, stretch)))

    def starts(h: Column) -> Column:
        least = F.transform(F.sequence(F.lit(1), F.size(h), F.lit(half)), lambda p: F.array_min(F.slice(h, p, F.lit(half))))

        # Conditions are evaluated up to the first that fails.
        def chosen(c: Column) -> Column:
            first = F.filter(c, lambda p: (p + width < F.size(h)) & all_of([F.get(h, p) <= F.get(h, p + j) for j in range(1, width + 1)]))
            last = F.filter(c, lambda p: (p >= width) & all_of([F.get(h, p) <= F.get(h, p - j) for j in range(1, width + 1)]))
            return F.sort_array(F.array_distinct(F.concat(first, F.transform(last, lambda p: p - width))))

        return bound(least, lambda m: bound(candidates(h, m), chosen))

    def block(code: Column, n: Column, begin: Column) -> Column:
        first = begin * 4 + 1
        most = F.least(n - s - begin, F.lit(BLOCK + width - 1))
        inner = F.transform(F.sequence(first, first + most * 4, F.lit(4)), lambda p: F.xxhash64(F.substring(code, p, F.lit(4 * s))))
        return F.transform(bound(inner, starts), lambda i: F.struct((begin + i).alias("at"), _short(cut_out(code, begin + i, k)).alias("h")))

    def of(code: Column) -> Column:
        n = (F.octet_length(code) / 4).cast("int")
        return F.flatten(F.transform(F.sequence(F.lit(0), n - k, F.lit(BLOCK)), lambda begin: block(code, n, begin)))

    return F.when(F.length(text) >= k, bound(F.encode(text, "UTF-32"), of).cast(ANCHORS)).otherwise(F.array().cast(ANCHORS))


def _whole(text: Column) -> Column:
    """The anchor of a text of few characters: all of them; none for an empty text."""
    return F.when(F.length(text) > 0, F.array(F.struct(F.lit(0).alias("at"), _short(F.encode(text, "UTF-32")).alias("h"))).cast(ANCHORS)).otherwise(F.array().cast(ANCHORS))


def syncmers(text: Column, k: int = LONG_K, s: int = LONG_S) -> Column:
    """All closed syncmers of a text's characters as structs (at, h), in order: the number of the first character, from 0, and a hash of 32 bits.

    Gaps between them are k - s characters at most. A text of fewer than k characters has one, of all
    of them; a null or empty one has none.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) >= k, _closed(text, k, s)).otherwise(_whole(text))


def syncmers_of_edit(own: Column, kept: Column, edited: Column, k: int = LONG_K, s: int = LONG_S) -> Column:
    """struct(lead, rest): syncmers of a text whose first ``kept`` characters are those of a text with the syncmers ``own``.

    What lies in the kept part needs no second look: lead counts those, the first ones of own; rest
    are the others.
    """
    lead = F.when(F.length(edited) >= k, F.size(F.filter(own, lambda x: x["at"] + k <= kept))).otherwise(0)
    begin = F.greatest(kept - k + 1, F.lit(0))
    rest = F.transform(_closed(F.substring(edited, begin + 1, F.length(edited)), k, s), lambda x: F.struct((x["at"] + begin).alias("at"), x["h"].alias("h")))
    return F.struct(lead.alias("lead"), F.when(F.length(edited) >= k, rest).otherwise(_whole(edited)).alias("rest"))


KEY = ["k", "z", "h"]


#: Rows of a run: neighbours in order that one task lines up.
RUN_ROWS = 64


def next_in_order(keys: DataFrame) -> DataFrame:
    """For distinct (z, k, h, copies): at, a number in ascending order, run, and joint: of a run's first row, the run before, around the end.

    z is 1 for an id and 0 for null, k the id or 0, h the hash of the text. The order is by ranges:
    each is walked by itself, and a table of one row a range joins them up.
    """
    spark = keys.sparkSession
    order = ["z", "k", "h"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The upper bits of at are the range's number, the lower ones count its rows.
    ranged = cut(keys.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    bits = RUN_ROWS.bit_length() - 1
    ranged = ranged.withColumn("run", F.shiftright("at", bits))
    ends = ranged.groupBy(F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.max("run").alias("end"))
    # A row for each range: no more than there are shuffle partitions.
    across = Window.orderBy("part")
    final = F.last("end").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    joints = ends.select(F.col("first").alias("of"), F.coalesce(F.lag("end").over(across), final).alias("joint"))
    joined = ranged.join(joints, ranged["at"] == joints["of"], "left")
    return joined.select(*KEY, "copies", "at", "run", F.coalesce("joint", F.when(F.col("at") % RUN_ROWS == 0, F.col("run") - 1)).alias("joint"))


def overlap(a: Column, b: Column) -> Column:
    """Number of matches() of two arrays of anchors' hashes: for each hash as often as the rarer has it.

    Where the hashes of either are distinct, as they mostly are, that is the size of an intersection.
    """
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    numbered = lambda c: F.transform(c, lambda h, i: F.struct(i.alias("at"), h.alias("h")))
    return F.when(once, F.size(F.array_intersect(a, b))).otherwise(F.size(matches(numbered(a), numbered(b))))


def in_place(a: Column, b: Column) -> Column:
    """Number of anchors that stand at the same position in both."""
    whole = lambda c: F.transform(c, lambda x: x["at"].cast("long") * (1 << 32) + x["h"])
    return F.size(F.array_intersect(whole(a), whole(b)))


def syncmer_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Anchors of every whole text, fingerprints of it and of its edited text, and how they match.

    anchors are all of them, with positions. near_edited and near_next are likeness() with the edited
    and next text; matched_edited and matched_next count the matches, kept_edited the anchors that
    stand at the same position in the edited text.

    The edited text ends in the first floor(n / 4) characters of the next document in ascending
    (doc_id, hash of the text) order instead of its own last ones; after the last comes the first;
    null ids come first. A null text is empty. Rows that repeat id and text are one document in the
    order: all but one of them are followed by their own copy. A text moves to its place in the order
    and then to its run of RUN_ROWS neighbours; a run's first text goes to the run before as well. So
    anchors are worked out once. An empty table gives no rows.
    """
    doc = F.col(id_col).cast("long")
    texts = docs.select(F.coalesce(doc, F.lit(0).cast("long")).alias("k"), doc.isNotNull().cast("int").alias("z"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = cut(next_in_order(texts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"))))
    repeats = not ordered.filter("copies > 1").isEmpty()
    if repeats:
        texts = texts.dropDuplicates(KEY)
    own = texts.join(ordered, KEY).select("z", "k", "text", "copies", "at", "run", "joint")
    # A guest, the next run's first row, is the last of a run.
    both = F.array_compact(F.array(F.struct(F.col("run"), F.lit(0).alias("guest")), F.when(F.col("joint").isNotNull(), F.struct(F.col("joint").alias("run"), F.lit(1).alias("guest")))))
    rows = own.withColumn("to", F.explode(both)).select("to.run", "to.guest", "z", "k", "text", "copies", "at")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "run").sortWithinPartitions("run", "guest", "at").withColumn("a", syncmers(F.col("text")))
    order = Window.partitionBy("run").orderBy("guest", "at")
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_hashes", F.lead(F.col("a.h")).over(order)).filter("guest = 0")
    if repeats:  # further copies, each followed by its own text
        again = F.struct((F.col("copies") - 1).alias("times"), F.col("text").alias("next_text"), F.col("a.h").alias("next_hashes"))
        once = F.struct(F.lit(1).cast("long").alias("times"), F.col("next_text"), F.col("next_hashes"))
        rows = rows.withColumn("to", F.explode(F.filter(F.array(once, again), lambda x: x["times"] > 0))).select("z", "k", "text", "a", "to.*")

    n = F.length("text")
    kept = n - F.expr("length(text) div 4").cast("int")
    rows = rows.withColumn("kept", kept).withColumn("edited", F.concat(F.left("text", F.col("kept")), F.left("next_text", n - F.col("kept"))))

    def compared(e: Column) -> Column:
        tail = lambda own: F.slice(own, e["lead"] + 1, F.size(own))
        a = F.col("a")
        return F.struct(
            digest(F.concat(F.slice(a, F.lit(1), e["lead"]), e["rest"])).alias("edited_fingerprint"),
            (e["lead"] + F.size(e["rest"])).alias("edited_anchors"),
            (e["lead"] + overlap(tail(a["h"]), e["rest"]["h"])).alias("matched_edited"),
            (e["lead"] + in_place(tail(a), e["rest"])).alias("kept_edited"),
        )

    rows = rows.withColumn("e", bound(syncmers_of_edit(F.col("a"), F.col("kept"), F.col("edited")), compared))
    rows = rows.withColumn("matched_next", overlap(F.col("a.h"), F.col("next_hashes")))
    near = lambda b, m: likeness(F.size("a"), b, F.col(m))
    out = rows.select("*", "e.*").select(
        F.when(F.col("z") == 1, F.col("k")).alias(id_col),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("a").alias("anchors"),
        digest(F.col("a")).alias("fingerprint"),
        "edited_fingerprint",
        near(F.col("edited_anchors"), "matched_edited").alias("near_edited"),
        "matched_edited",
        "kept_edited",
        near(F.size("next_hashes"), "matched_next").alias("near_next"),
        "matched_next",
        *(["times"] if repeats else []),
    )
    return out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times") if repeats else out
