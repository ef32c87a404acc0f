"""Line deduplication by overlapping three-line windows, in DataFrame operations only.

Lines without a word form no windows. Every three consecutive other lines of a text are a window,
known by the MD5 of its lines. Of the occurrences of a window in all texts the first, by document
and place, stays; the stretches of the others, from the first to the third line, are merged and
removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.names import plain_names

WIDTH = 3
HAS_WORD = "[^\\x20\\x09-\\x0D]"


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_md5, window, first_line, last_line) for every window of every text."""
    lines = F.transform(_split(F.col("text")), lambda line, i: F.struct(i.alias("at"), F.when(line.rlike(HAS_WORD), F.unhex(F.md5(line))).alias("line")))
    spoken = docs.where("text is not null").select("doc_id", F.unhex(F.md5("text")).alias("text_md5"), F.filter(lines, lambda x: x["line"].isNotNull()).alias("said"))
    said = F.col("said")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(said) - WIDTH),
        lambda i: F.struct(F.unhex(F.md5(F.concat(*[said[i + k]["line"] for k in range(WIDTH)]))).alias("window"), said[i]["at"].alias("first_line"), said[i + WIDTH - 1]["at"].alias("last_line")),
    )
    return spoken.select("doc_id", "text_md5", F.inline(F.when(F.size(said) >= WIDTH, windows)))


def later_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_md5, gone): for each text with later occurrences, the numbers of the lines they
    cover. A window's first occurrence is a grouped minimum with partial aggregation, and only
    windows that occur twice are joined back, so a line that a third of all texts hold is one row
    on the grouped side; the other side is split by the adaptive skew join."""
    windows = line_windows(docs)
    place = F.struct("doc_id", "text_md5", "first_line")
    twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("kept")).where("n > 1").select("window", "kept")
    later = windows.join(twice, "window").where(~place.eqNullSafe(F.col("kept")))
    covered = later.select("doc_id", "text_md5", F.explode(F.sequence("first_line", "last_line")).alias("line"))
    return covered.groupBy("doc_id", "text_md5").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with later lines removed from ``text``, plus
    n_lines and n_removed.

    Texts come in order of doc_id, a null id first, then of the MD5 of the text. Rows with equal id
    and text are one document: none of them is a later occurrence of another. A null text stays
    null and has 0 lines, an empty text has one line; texts of fewer than three lines with words
    are left alone. An empty table gives an empty result. Columns of ``docs`` that are named like a
    column made here are kept under their name, but for n_lines and n_removed, which are replaced.
    """
    gone = later_lines(docs.select("doc_id", "text")).select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5"), F.col("gone").alias("_gone"))
    docs = docs.drop("n_lines", "n_removed")
    rows = plain_names(docs, "doc_id", "text")
    joined = rows.join(gone, rows["doc_id"].eqNullSafe(F.col("_id")) & (F.unhex(F.md5(rows["text"])) == F.col("_md5")), "left")
    lines = _split(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    fresh = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    made = {
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
    }
    out = joined.select(*[(fresh if c == "text" else F.col(c)).alias(c) for c in rows.columns], *[v.alias(k) for k, v in made.items()])
    return out.toDF(*docs.columns, *made)


def without_later_lines(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` after ``dedup_lines``, ``n_chars`` kept true if there is one;
    a document that loses its last word goes. Null and empty texts lose nothing and stay; equal rows
    all stay or all go; an empty table gives an empty result. All other columns keep their values,
    whatever their names."""
    rows = plain_names(docs, "doc_id", "text", "n_chars")
    fresh = dedup_lines(rows)
    left = fresh.where((F.col("n_removed") == 0) | F.col("text").rlike(HAS_WORD))
    if "n_chars" in docs.columns:
        chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return left.select(*rows.columns).toDF(*docs.columns)
