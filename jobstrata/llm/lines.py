"""Removal of repeated runs of lines by winnowing over line hashes.

A window is the shortest run of lines from a line on, or up to a line, with ``least`` words
in all. Every window selects the place of its smallest line hash, the first of equal ones; windows
that overlap select mostly the same place, so a document has fewer selected places than
lines. Two equal runs of ``least`` words hold equal windows and so selected places with equal
hashes: that is guaranteed. Selected places are joined on their hash; one whose hash no other
place has is in no repeated run and goes no further. From each of the others its windows extend,
both ways, and are compared whole, by a hash of their lines: equal ones at an earlier place
make a match. Windows of one run overlap or touch, and their union is the run. Every line of a
window whose content occurred earlier is deleted. Earlier means a smaller doc_id, or the same
document further up.

The outcome: a line goes if and only if it lies in a run of at least ``least`` words that
also occurs, line by line, at an earlier position. Lines without words do not count as lines
of a run and go with the run around them.

Only DataFrame functions are used. Texts are shuffled once, to be rebuilt; all else moves
hashes and places. The first place of a window's content is found by a combined aggregate, and
the others are linked to it alone, so a passage in n documents makes n rows; very common
hashes and contents are joined by broadcast.

Defined cases: a null text stays null, an empty one empty; a text all of whose lines go
becomes empty; rows equal in doc_id and text are one document and all keep the same lines;
a null doc_id comes first; other columns are kept, whatever their names; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobstrata.llm.common import as_row, join_counted, stored, word_count

LEAST_WORDS = 50
_KEY = ("doc_id", "text_hash")


def _lines(docs: DataFrame) -> DataFrame:
    """Lines with words: place, two hashes, words, and words before and through them."""
    exploded = docs.where("text IS NOT NULL").select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split("text", "\n", -1)).alias("place", "line"),
    )
    counted = exploded.select(
        *_KEY,
        "place",
        F.xxhash64("line").alias("hash"),
        F.xxhash64(F.lit(7), F.col("line")).alias("other_hash"),
        word_count(F.col("line")).alias("words"),
    ).where("words > 0")
    once = counted.repartition(*_KEY).dropDuplicates([*_KEY, "place"])
    through = F.sum("words").over(Window.partitionBy(*_KEY).orderBy("place"))
    return once.withColumn("through", through).withColumn(
        "before", F.col("through") - F.col("words")
    )


def selected_places(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """A row per place that windows select: its document, place and line hash, and those
    windows with a hash of their content, first and last place."""
    document = Window.partitionBy(*_KEY)
    # From a line on: lines that begin before ``least`` words are reached; and up to a line.
    onward = document.orderBy("before").rangeBetween(0, least - 1)
    back = document.orderBy("through").rangeBetween(-(least - 1), 0)
    place = F.col("place")

    def window(frame, first, last):
        return F.struct(
            F.min(F.struct("hash", "place")).over(frame).alias("least"),
            F.xxhash64(F.collect_list("other_hash").over(frame)).alias("content"),
            F.sum("words").over(frame).alias("all_words"),
            first.alias("first"),
            last.alias("last"),
        )

    # A line that is a window by itself is both; it is taken once.
    both = F.array(
        window(onward, place, F.max("place").over(onward)),
        F.when(F.col("words") < least, window(back, F.min("place").over(back), place)),
    )
    rows = _lines(docs).select(*_KEY, both.alias("both")).select(*_KEY, F.explode("both").alias("w"))
    return (
        rows.where(F.col("w.all_words") >= least)
        .groupBy(*_KEY, F.col("w.least.place").alias("place"), F.col("w.least.hash").alias("hash"))
        .agg(F.collect_list(F.struct("w.content", "w.first", "w.last")).alias("windows"))
    )


def repeated_places(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Per document the places of lines in repeated runs."""
    selected = stored(selected_places(docs, least), "selected")
    hashes = selected.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    hashes = stored(hashes.withColumn("met", F.lit(True)), "met")
    met = join_counted(selected, hashes, "hash", "times").where("met")
    found = met.select(*_KEY, "hash", F.explode("windows").alias("w")).select(
        *_KEY, F.struct("hash", "w.content").alias("content"), "w.first", "w.last"
    )
    found = stored(found, "windows")
    at = F.struct(*_KEY, "first")
    firsts = (
        found.groupBy("content")
        .agg(F.min(at).alias("original"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
    )
    matched = join_counted(found, stored(firsts, "firsts"), "content", "times")
    later = matched.where(F.col("original").isNotNull() & (at != F.col("original")))
    places = later.select(*_KEY, F.explode(F.sequence("first", "last")).alias("place"))
    return places.groupBy(*_KEY).agg(F.collect_set("place").alias("places"))


def remove_repeated_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with shortened texts and a column removed_lines."""
    places = repeated_places(docs, least)
    rows = docs.select(as_row(docs), F.xxhash64("text").alias("hash"))
    matched = rows.join(
        places,
        F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")),
        "left",
    )
    # The one-element array binds the split lines, so that they are split once per text.
    held = F.array(F.struct(F.split("row.text", "\n", -1).alias("lines"), "places"))

    def rebuilt(held):
        every = F.sequence(F.lit(0), F.size(held["lines"]) - 1)
        kept = F.array_except(every, held["places"])
        return F.array_join(F.transform(kept, lambda i: F.get(held["lines"], i)), "\n")

    whole = F.col("places").isNull()
    text = F.when(whole, F.col("row.text")).otherwise(
        F.get(F.transform(held, rebuilt), F.lit(0))
    )
    names = [c for c in docs.columns if c != "removed_lines"]
    return matched.select(
        *[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in names],
        F.when(whole, F.lit(0)).otherwise(F.size("places")).alias("removed_lines"),
    )
