"""Audit of how filters interact: what each filter removes in each order of application.

Each document fails or passes each of five filters. All that an order's figures depend on are the
counts of the 32 combinations of failures in a part of the corpus, so texts are read once, by
DataFrame functions, and grouped to at most 32 rows a part. Reshaped to 2 x 2 x 2 x 2 x 2, one
einsum with a 3 x 2 selector (pass, fail, all) on each axis gives the count of each of the 243
selections, and every figure of the 120 orders is one of these or a difference of two.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
SPACE = "[\\x20\\x09-\\x0D]+"
#: Rows of the selector: pass, fail, all; columns: documents that pass, documents that fail.
SELECT = np.array([[1, 0], [0, 1], [1, 1]], np.int64)
PASS, FAIL, ALL = range(3)
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDITED = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in FIGURES)


def text_failures(text: Column) -> Column:
    """The failures of filters A to D as bits 0 to 3 of an int."""
    words = F.array_remove(F.split(text, SPACE), "")
    counted = F.struct(F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("different"))
    upper = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = [
        counted["n"] < 100,
        100 * counted["different"] < 80 * counted["n"],
        100 * upper.cast("long") > 10 * F.char_length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cell, n, good, toxic): how many documents of a part have the failures ``cell`` (bit i:
    filter i), and how many of these are labelled good or toxic.

    Texts are compared by length and SHA-256. All copies of a text have equal failures A to D, so
    they meet as pre-aggregated counts, never as rows: a text that a third of all documents share
    is a few rows of its group, and those above the group's smallest id are counted, not joined.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.char_length(text).alias("chars"),
        text_failures(text).alias("cell"),
    )
    said = ["digest", "chars", "part", "cell"]
    rows = facts.groupBy("doc_id", *said).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.coalesce(F.col("quality"), F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce(F.col("toxic"), F.lit(0)) == 1).cast("int")).alias("toxic"),
    )
    # rows without an id have no label; they stay out of the join, where they would be one hot key
    named = rows.where("doc_id is not null").join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    unnamed = rows.where("doc_id is null").select("*", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    groups = named.unionByName(unnamed).groupBy(*said, "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by("n", F.col("doc_id")), F.lit(0).cast("long")).alias("n_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_unnamed"),
    )
    first = F.min("least").over(Window.partitionBy("digest", "chars"))
    passing = F.col("n_unnamed") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = groups.withColumn("first", first).select("part", "cell", "good", "toxic", "n", passing.alias("n_pass"))
    e = 1 << FILTERS.index("E")
    both = F.inline(F.array(F.struct(F.col("cell"), F.col("n_pass").alias("m")), F.struct((F.col("cell") + e).alias("cell"), (F.col("n") - F.col("n_pass")).alias("m"))))
    cells = split.select("part", "good", "toxic", both).where("m > 0")
    return cells.groupBy("part", "cell").agg(
        F.sum("m").alias("n"), F.sum(F.col("m") * F.col("good")).alias("good"), F.sum(F.col("m") * F.col("toxic")).alias("toxic")
    )


def selections(counts: np.ndarray) -> np.ndarray:
    """From counts of the 32 cells (last axis, bit i: filter i) the 243 counts of documents that pass
    (0), fail (1) or may do either (2) for each filter, filter A on the axis after the first."""
    cube = counts.reshape(-1, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1)  # the lowest bit varies fastest
    return np.einsum("qabcde,ia,jb,kc,ld,me->qijklm", cube, SELECT, SELECT, SELECT, SELECT, SELECT, optimize=True)


def audit_part(part: str, counts: np.ndarray) -> pd.DataFrame:
    """The 600 rows of a part from its 3 x 32 counts (all, good and toxic documents)."""
    chosen = selections(counts)
    every, good, toxic = chosen
    rows, total = [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        at = [ALL] * len(FILTERS)
        for step, name in enumerate(order, 1):
            i = FILTERS.index(name)
            at[i] = FAIL
            here = tuple(at)
            alone = tuple(FAIL if k == i else ALL for k in range(len(FILTERS)))
            only = tuple(FAIL if k == i else PASS for k in range(len(FILTERS)))
            removed = int(every[here])
            at[i] = PASS
            total[name] += removed
            rows.append([part, "".join(order), step, int(every[tuple(at)]), removed, int(every[alone]) - removed, int(every[only]), int(good[here]), int(toxic[here])])
    for row in rows:
        row.append(total[row[1][row[2] - 1]])
    return pd.DataFrame(rows, columns=["part", "filter_order", "step", *FIGURES])


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (``lang``; null: empty string), order of the five filters and step.

    A null text counts as an empty one. E fails a document whose text a smaller doc_id has, whether
    or not another filter removes that one; a null id is neither smaller nor larger, so such rows
    pass E, and rows with equal id and text do not fail each other. A document is good or toxic if
    any of its rows in ``labels`` (doc_id, quality, toxic) has 1 there; null ids have no labels.
    Repeated rows count as often as they occur. An empty table gives an empty result; other columns
    are not read. ``shapley`` is the sum of ``removed`` over all 120 orders.
    """
    counts = failure_counts(docs, labels)

    def audit(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((3, 32), np.int64)
        table[:, cells["cell"]] = cells[["n", "good", "toxic"]].to_numpy().T
        return audit_part(key[0], table)

    return counts.groupBy("part").applyInPandas(audit, AUDITED)
