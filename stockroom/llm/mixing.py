"""Mixing of sources to target weights by a low-discrepancy schedule.

Each source's documents, in a shuffled order that depends on a seed and the document ids only, form
one stream of words, cut into blocks of equal length. The schedule is a sequence of slots; the
point of slot i is the fractional part of i times the golden ratio, and the source whose interval
of the cumulative weights holds the point gets the slot. The r-th slot of a source takes the
(r mod blocks)-th block of its stream, so a source whose target exceeds its size starts over. The
last block of a source is cut to its quota.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.names import plain_names
from stockroom.llm.running import running_total
from stockroom.session import materialize

GOLDEN = 0.6180339887498949  # fractional part of the golden ratio
WORD = "[^\\x20\\x09-\\x0D]+"
_HIGH = 1 << 20
#: The shuffled order of a source's rows.
ORDER = ["_order", "doc_id", "size", "digest", "_tie"]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """``sizes`` (key, source_size; one row per source) plus ``target``.

    Sources in order of ``key`` get the weights in turn. The target of a source is the smaller of
    ``cap`` times its size and its weight times a level; the level is the one at which the targets
    add up to the sum of all sizes. That is where sharing by weight and sharing the excess of
    capped sources again and again ends. Windows here see one row per source.
    """
    picks = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("_w", F.element_at(picks, ((F.row_number().over(Window.orderBy("key")) - 1) % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("_cap", F.col("source_size") * cap).withColumn("_level", F.col("_cap") / F.col("_w"))
    upto = Window.orderBy("_level", "key").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(0))
    filled = ranked.select(
        "*",
        F.sum("_cap").over(upto).alias("_caps"),
        F.sum("_w").over(upto).alias("_ws"),
        F.sum("source_size").over(everything).alias("_total"),
        F.sum("_w").over(everything).alias("_weights"),
    )
    # the level if this source and all with lower limits were at their limits, the others below
    rest_words, rest_weight = F.col("_total") - F.col("_caps") + F.col("_cap"), F.col("_weights") - F.col("_ws") + F.col("_w")
    filled = filled.withColumn("_try", rest_words / rest_weight).withColumn("_open", F.col("_level") >= F.col("_try"))
    level = F.min(F.when(F.col("_open"), F.struct("_level", "key", "_try"))).over(everything)["_try"]
    target = F.when(F.col("_open"), F.col("_w") * level).otherwise(F.col("_cap").cast("double"))
    return filled.select("key", "source_size", target.alias("target"))


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """Slots (slot, key, rank, block, words) that serve each source's quota, its rounded target.

    Sources with a quota get ``points`` as described above, joined by a grid over the cumulative
    weights, so no side has to be broadcast. Slots of a source past its quota are dropped, and what
    rounding left unserved follows at the end.
    """
    spark = targets.sparkSession
    blocks = F.ceil(F.col("source_size") / block_words)
    quota = targets.where("source_size > 0").select(
        "key",
        F.col("source_size").alias("stream"),
        F.round("target").cast("long").alias("quota"),
        blocks.cast("long").alias("blocks"),
    ).where("quota > 0")
    rest = F.col("quota") % F.col("stream")
    quota = quota.withColumn("epochs", F.expr("quota div stream")).withColumn("rest", rest)
    quota = quota.withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block_words).cast("long"))
    upto = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    quota = quota.withColumn("_to", F.sum("slots").over(upto)).withColumn("_all", F.sum("slots").over(Window.partitionBy(F.lit(0))))
    quota = quota.withColumn("_from", (F.col("_to") - F.col("slots")) / F.col("_all")).withColumn("_to", F.col("_to") / F.col("_all"))
    quota = materialize(quota, "mix-quota")
    n_slots, n_sources = quota.agg(F.coalesce(F.max("_all"), F.lit(0)), F.count(F.lit(1))).first()
    grid = max(1024, n_sources)

    high, low = F.expr(f"id div {_HIGH}"), F.col("id") % _HIGH
    turned = high * ((_HIGH * GOLDEN) % 1.0) + low * GOLDEN
    points = spark.range(n_slots).select(F.col("id").alias("slot"), (turned - F.floor(turned)).alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * grid).cast("long"))
    cells = quota.select("key", "_from", "_to", F.explode(F.sequence(F.floor(F.col("_from") * grid), F.floor(F.col("_to") * grid))).alias("cell"))
    hits = points.join(cells, "cell").where("x >= _from and x < _to")
    slots = materialize(hits.select("slot", "key", F.expr("slot div 65536").alias("_chunk"), F.lit(1).cast("long").alias("_one")), "mix-slots")
    ranked = running_total(slots, "key", "_chunk", ["slot"], "_one", "rank").select("slot", "key", "rank")
    served = slots.groupBy("key").agg(F.count(F.lit(1)).alias("_served"))
    short = quota.join(served, "key", "left").withColumn("_served", F.coalesce("_served", F.lit(0)))
    late = short.where("_served < slots").select("key", F.explode(F.expr("sequence(_served, slots - 1)")).alias("rank"))
    late = late.select((F.lit(n_slots) + F.col("rank")).alias("slot"), "key", "rank")
    taken = ranked.unionByName(late).join(quota.select("key", "stream", "blocks", "epochs", "rest", "slots"), "key").where("rank < slots")
    block = F.col("rank") % F.col("blocks")
    limit = F.when(F.expr("rank div blocks") < F.col("epochs"), F.col("stream")).otherwise(F.col("rest"))
    words = F.least(F.lit(block_words).cast("long"), limit - block * block_words)
    return taken.select("slot", "key", "rank", block.alias("block"), words.alias("words"))


def _named(source: Column) -> Column:
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def _runs(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_part``, the number of a range of (key, ORDER). Equal rows are told apart by
    ``_tie``, so rows of one id, or of one id and size, fill as many ranges as their number asks for."""
    told = rows.withColumn("_tie", F.monotonically_increasing_id())
    return told.repartitionByRange("key", *ORDER).withColumn("_part", F.spark_partition_id())


def _taken(docs: DataFrame, weights: tuple[int, ...], cap: int, block_words: int, seed: int, digests: bool) -> DataFrame:
    """The rows of ``mix_documents`` with the key of their source and, if ``digests``, the MD5 of
    their text, else null."""
    mixed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        (F.unhex(F.md5("text")) if digests else F.lit(None).cast("binary")).alias("digest"),
        _named(F.col("source")).alias("key"),
        mixed.alias("_order"),
    )
    rows = materialize(rows, "mix-sizes")
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, cap), "mix-targets")
    use = schedule(targets, block_words)

    placed = running_total(materialize(_runs(rows.where("size > 0")), "mix-order"), "key", "_part", ORDER, "size", "start")
    span = F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))
    pieces = placed.select("doc_id", "digest", "size", "key", "start", F.explode(span).alias("block"))
    first = F.greatest(F.col("start"), F.col("block") * block_words)
    until = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.coalesce("words", F.lit(0)))
    used = pieces.join(use.select("key", "block", "words"), ["key", "block"], "left")
    got = F.coalesce(F.greatest(until - first, F.lit(0)), F.lit(0))
    taken = used.groupBy("doc_id", "digest", "size", "key", "start").agg(F.sum(got).alias("taken")).drop("start")
    empty = rows.where("size = 0").select("doc_id", "digest", "size", "key", F.lit(0).cast("long").alias("taken"))
    out = taken.unionByName(empty).join(targets, "key")
    return out.select("doc_id", "digest", "key", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block_words: int = 4096, seed: int = 0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): size, source_size, target, taken.

    Size is the number of words of the text (null or empty: 0). Sources stand in code point order,
    null last as a source of its own. ``taken`` counts the words of the document in all blocks that
    the schedule takes, repeats included; it is at most ``cap`` times the size. Documents without
    words are taken 0 times. Equal rows are separate documents; which of them a cut falls on does
    not show in the result as a whole. Null ids are shuffled as one id. An empty table gives an
    empty result; other columns are not read. Only (id, source, size) rows are shuffled, and they
    are numbered in ranges of their order, so neither a source nor an id that holds most rows is
    numbered by one task.
    """
    taken = _taken(docs, weights, cap, block_words, seed, digests=False)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def draw_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block_words: int = 4096, seed: int = 0) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_documents`` takes it, with all their columns:
    not at all if nothing of it is taken, and the document on which a source's quota ends whole.
    Rows are told apart by id, source and text; rows equal in these share the sum of their copies
    evenly, in order of all their columns. Rows without words, null texts among them, are not taken; an
    empty table gives an empty result."""
    names, docs = docs.columns, plain_names(docs, "doc_id", "text", "source")
    mixed = _taken(docs, weights, cap, block_words, seed, digests=True)
    times = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("long")
    copies = mixed.groupBy("doc_id", "digest", "key").agg(F.sum(times).alias("_copies"), F.count(F.lit(1)).alias("_rows")).where("_copies > 0")
    copies = materialize(copies.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("key").alias("_key"), "_copies", "_rows"), "mix-copies")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.unhex(F.md5(docs["text"])) == F.col("_digest")) & (_named(docs["source"]) == F.col("_key"))
    out = _repeated(docs.join(copies.where("_rows = 1"), same), F.col("_copies"), docs.columns)
    several = copies.where("_rows > 1").withColumn("_equal", F.monotonically_increasing_id())
    if several.limit(1).count():
        # identical rows become one row with a number before they are put in order
        several = materialize(several, "mix-copies")
        equal = docs.join(several, same).groupBy("_equal", "_copies", "_rows", *[docs[c] for c in docs.columns]).agg(F.count(F.lit(1)).alias("_n"))
        equal = materialize(equal.withColumn("_cell", F.pmod(F.xxhash64(*docs.columns), F.lit(4096))), "mix-equal")
        ranked = running_total(equal, "_equal", "_cell", docs.columns, "_n", "_start")
        share = F.expr("(_start + _n) * _copies div _rows - _start * _copies div _rows")
        out = out.unionByName(_repeated(ranked, share, docs.columns))
    return out.toDF(*names)


def _repeated(rows: DataFrame, times: Column, columns: list[str]) -> DataFrame:
    wanted = rows.withColumn("_times", times).where("_times > 0")
    return wanted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select(*columns)
