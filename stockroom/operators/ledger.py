"""Ordered, oversell-guarded, idempotent application of event batches.

Semantics (sequential per interacting group, in arrival order):

* a unit is one incoming row plus, for a newly recorded SALE of a dish, one SALE per recipe
  component (``{event_id}:component:{component_id}``, quantity x units sold); a unit is
  accepted or refused as a whole;
* an id already recorded (in the log, or accepted earlier in the batch) is a success that
  changes nothing and cascades nothing; a refused id is evaluated afresh when it repeats;
* the sign rule is checked after the idempotency test; SALE/DAMAGE/WASTE are refused when
  they would take the balance below zero; ADJUSTMENT may go negative.

Plan:

1. **Groups** (O5): products that can influence each other (recipe edges, and products that
   share a repeated event id) get one ``group_id`` by iterative min-label propagation.
2. **Fast path**: with no refusal the fold equals a prefix sum. A window sum per product over
   the rows that would apply finishes clean groups, and dirty ones up to their first refusal, in
   SQL. How much that is depends on the batch: on the driver's tables most rows come after a
   refusal (61-94 %), since stock starts near zero there.
3. **Slow path**: the rest of dirty groups is hash-partitioned by group, sorted by arrival, and
   folded by a streaming ``mapInPandas``: memory is the group's balances and its repeated
   ids, never the group's rows.
4. **Hot groups**: a group with very many such rows is cut into chunks by arrival number, and all
   chunks are folded at once from guessed balances (``fold_hot``). A chunk's outcome holds for every
   start that changes none of its decisions; a chain over a few numbers per chunk finds the chunks
   whose guess was off, and only these are folded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom import schemas as S
from stockroom.functions.events import is_guarded, sign_error
from stockroom.session import materialize

KEY = ["organization_id", "event_id"]


# ---- O5: interaction groups -------------------------------------------------------------------------
def connected_groups(edges: DataFrame) -> DataFrame:
    """Connected components over undirected ``(organization_id, a, b)`` edges.

    Each round takes the minimum label over a node's neighbours (one join + aggregation) and
    then jumps pointers (a node adopts the label of its label, one more join), so labels
    spread along long chains in about log2(diameter) rounds instead of one hop per round.
    Each round's labels are written once to the shared checkpoint folder, so the plan stays
    flat however many rounds run; the only value brought to the driver per round is whether
    any label moved. Returns ``(organization_id, product_id, group_id)`` for every node.
    """
    both = edges.select("organization_id", F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        edges.select("organization_id", F.col("b").alias("src"), F.col("a").alias("dst"))
    ).distinct()
    labels = both.groupBy("organization_id", "src").agg(F.least(F.col("src"), F.min("dst")).alias("label"))
    labels = materialize(labels.withColumnRenamed("src", "node"), "group-labels")
    while True:
        nbr = (
            both.join(labels.withColumnRenamed("node", "src"), ["organization_id", "src"])
            .groupBy("organization_id", "dst")
            .agg(F.min("label").alias("nbr_label"))
            .withColumnRenamed("dst", "node")
        )
        hop = labels.join(nbr, ["organization_id", "node"], "left").select(
            "organization_id",
            "node",
            F.col("label").alias("old"),
            F.least("label", F.coalesce("nbr_label", "label")).alias("label"),
        )
        parent = labels.select("organization_id", F.col("node").alias("label"), F.col("label").alias("grand"))
        new = hop.join(parent, ["organization_id", "label"], "left").select(
            "organization_id",
            "node",
            F.least("label", F.coalesce("grand", "label")).alias("label"),
            "old",
        )
        new = materialize(new.withColumn("moved", F.col("label") < F.col("old")).drop("old"), "group-labels")
        moved = new.filter("moved").limit(1).count()
        labels = new.drop("moved")
        if moved == 0:
            break
    return labels.select("organization_id", F.col("node").alias("product_id"), F.col("label").alias("group_id"))


def recipe_edges(recipe_items: DataFrame) -> DataFrame:
    return recipe_items.select(
        "organization_id", F.col("finished_product_id").alias("a"), F.col("component_product_id").alias("b")
    )


def repeated_id_edges(rows: DataFrame) -> DataFrame:
    """Products touched by the same ``(org, event_id)`` in one batch must fold together.

    Star edges to the smallest product of each id, built by aggregate + join (no per-id
    collection, so an id repeated on very many rows costs a shuffle, not a giant array).
    """
    spans = rows.groupBy(*KEY).agg(F.min("product_id").alias("a"), F.max("product_id").alias("mx")).filter(
        F.col("a") != F.col("mx")
    )
    return (
        rows.select(*KEY, F.col("product_id").alias("b"))
        .join(spans.select(*KEY, "a"), KEY, "inner")
        .filter(F.col("a") != F.col("b"))
        .select("organization_id", "a", "b")
        .distinct()
    )


# ---- J3 / J4 / U3: expand the batch into fold rows -----------------------------------------------------
def expand_units(events: DataFrame, recipe_items: DataFrame | None = None) -> DataFrame:
    """Fold rows: the incoming rows (``pos`` 0) plus cascade rows of SALE rows (``pos`` >= 1).

    ``events``: organization_id, product_id, event_id, event_type, quantity (raw, non-zero),
    seq (unique arrival number). Cascade rows are produced for every SALE with a valid sign;
    whether they apply is decided with their leader.
    """
    base = events.select(
        "organization_id",
        "product_id",
        "event_id",
        "event_type",
        F.col("quantity").cast("long").alias("quantity"),
        F.col("seq").cast("long").alias("seq"),
        F.lit(0).alias("pos"),
    )
    if recipe_items is None:
        return base
    sales = base.filter((F.col("event_type") == "SALE") & (F.col("quantity") > 0))
    items = recipe_items.select(
        "organization_id",
        F.col("finished_product_id").alias("product_id"),
        F.col("component_product_id"),
        F.col("quantity").alias("per_unit"),
        F.row_number()
        .over(Window.partitionBy("organization_id", "finished_product_id").orderBy("recipe_item_id"))
        .alias("pos"),
    )
    comps = sales.drop("pos").join(items, ["organization_id", "product_id"], "inner").select(
        "organization_id",
        F.col("component_product_id").alias("product_id"),
        F.concat(F.col("event_id"), F.lit(":component:"), F.col("component_product_id").cast("string")).alias(
            "event_id"
        ),
        F.lit("SALE").alias("event_type"),
        (F.col("per_unit") * F.col("quantity")).alias("quantity"),
        "seq",
        "pos",
    )
    return base.unionByName(comps)


def annotate(
    rows: DataFrame, log_ids: DataFrame | None, start: DataFrame | None, unique_ids: bool = False
) -> DataFrame:
    """Sign rule, guard flag, already-recorded flag (J3), starting balance, and per id: whether
    it repeats in the batch and its first valid occurrence ``first_valid`` = (seq, pos).

    Per-id facts come from an aggregation joined back on the id (partial aggregation, and
    AQE splits the join if one id is hot), not from a window that would put all copies of a
    hot id into one task. ``unique_ids`` is the caller's promise that no ``(org, event_id)``
    repeats in the batch; it skips that aggregation."""
    out = rows.withColumn("sign_error", sign_error("event_type", "quantity")).withColumn(
        "delta",
        F.when(F.col("sign_error").isNull(), F.when(is_guarded("event_type"), -F.col("quantity")).otherwise(F.col("quantity"))),
    ).withColumn("guarded", is_guarded("event_type"))
    if log_ids is not None:
        # Only log rows with an id of this batch matter: the semi join lets a batch that turns out
        # small be broadcast (adaptively, by its measured size), so the log need not be shuffled.
        asked = rows.select(*KEY).distinct()
        recorded = log_ids.select(*KEY).join(asked, KEY, "left_semi").distinct().withColumn("in_log", F.lit(True))
        out = out.join(recorded, KEY, "left").withColumn("in_log", F.coalesce("in_log", F.lit(False)))
    else:
        out = out.withColumn("in_log", F.lit(False))
    if start is not None:
        s = start.select("organization_id", "product_id", F.col("quantity").cast("long").alias("start_balance"))
        out = out.join(s, ["organization_id", "product_id"], "left")
        out = out.withColumn("start_balance", F.coalesce("start_balance", F.lit(0).cast("long")))
    else:
        out = out.withColumn("start_balance", F.lit(0).cast("long"))
    valid = F.col("delta").isNotNull() & ~F.col("in_log")
    mine = F.when(valid, F.struct("seq", "pos"))
    if unique_ids:
        return out.withColumn("repeated", F.lit(False)).withColumn("first_valid", mine)
    per_id = out.groupBy(*KEY).agg(
        (F.count(F.lit(1)) > 1).alias("repeated"), F.min(mine).alias("first_valid")
    )
    return out.join(per_id, KEY, "inner")


# ---- O1 fast path ----------------------------------------------------------------------------------------
def _effective(rows: DataFrame, cascades: bool = True) -> DataFrame:
    """Flag the rows that apply when nothing is refused (first valid occurrence of each id,
    not yet recorded, and for cascade rows: their leader applies)."""
    valid = F.col("delta").isNotNull() & ~F.col("in_log")
    r = rows.withColumn("self_first", valid & (F.struct("seq", "pos") == F.col("first_valid")))
    if cascades:
        # A unit is one row plus its recipe components: bounded by the recipe size.
        lead = Window.partitionBy("organization_id", "group_id", "seq")
        leader_applies = F.max(F.when(F.col("pos") == 0, F.col("self_first").cast("int"))).over(lead) == 1
    else:
        leader_applies = F.col("self_first") | (F.col("pos") == 0)
    return r.withColumn("leader_applies", leader_applies).withColumn(
        "effective", F.col("self_first") & F.col("leader_applies")
    )


def fold_fast(rows: DataFrame, cascades: bool = True, by_product: bool = False, chunk: int = 1 << 16) -> DataFrame:
    """Prefix balances under 'nothing refused', the group's ``cut`` and, for products that are groups of
    their own (``by_product``), what was accepted before it (``_pre``); written as a table.

    The prefix sum per product is computed in chunks of ``chunk`` arrival numbers: a local
    running sum inside (product, chunk), plus the sum of the product's earlier chunks (a
    window over one row per chunk). A product holding a large share of the batch is spread
    over many tasks instead of one. The rows are sent by chunk and written once; only chunks
    that have earlier ones of their product take an offset. The cut is an aggregation per
    group joined back, or that of the only chunk of a product that is its own group.
    """
    at = ["organization_id", "product_id", "_chunk"]
    r = _effective(rows, cascades).withColumn("_chunk", F.floor(F.col("seq") / chunk)).dropna(subset=[*at, "group_id"])
    eff_delta = F.when(F.col("effective"), F.col("delta")).otherwise(F.lit(0))
    here = Window.partitionBy(*at)
    local_w = here.orderBy("seq", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("_local", F.sum(eff_delta).over(local_w))
    bad = F.col("effective") & F.col("guarded") & (F.col("running") < 0)
    if by_product:
        r = r.withColumn("running", F.col("start_balance") + F.col("_local"))
        r = r.withColumn("cut", F.min(F.when(bad, F.col("seq"))).over(here)).withColumn("_pre", F.sum(F.when(_accepted_before(), F.col("delta"))).over(here))
    r = materialize(r, "fold-local")
    totals = r.groupBy(*at).agg(F.sum(eff_delta).alias("_tot"))
    before = Window.partitionBy("organization_id", "product_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*at, F.sum("_tot").over(before).alias("_offset")).where(F.col("_offset").isNotNull())
    offsets = materialize(offsets, "fold-offsets")
    if by_product and offsets.isEmpty():  # every product is in one chunk
        return r.drop("_chunk", "_local").withColumn("dirty", F.col("cut").isNotNull())
    running = F.col("start_balance") + F.coalesce("_offset", F.lit(0)) + F.col("_local")
    if not by_product:
        r = r.join(offsets, at, "left").withColumn("running", running).drop("_chunk", "_local", "_offset")
        # ``cut``: arrival number of the group's first unit that may be refused (NULL = clean).
        flags = r.groupBy(*GROUP).agg(F.min(F.when(bad, F.col("seq"))).alias("cut"))
        return materialize(r.join(flags, GROUP, "inner").withColumn("dirty", F.col("cut").isNotNull()), "fold-judged")
    key = ["organization_id", "product_id"]
    wide = offsets.select(*key).distinct().withColumn("_wide", F.lit(True))
    r = r.join(wide, key, "left")
    one = r.where(F.col("_wide").isNull()).drop("_wide", "_chunk", "_local")
    many = r.where("_wide").drop("_wide", "cut", "_pre").join(offsets, at, "left").withColumn("running", running).drop("_chunk", "_local", "_offset")
    many = many.join(many.groupBy(*key).agg(F.min(F.when(bad, F.col("seq"))).alias("cut")), key)
    many = materialize(many, "fold-wide")
    pre = many.where(_accepted_before()).groupBy(*key).agg(F.sum("delta").alias("_pre"))
    return one.unionByName(many.join(pre, key, "left")).withColumn("dirty", F.col("cut").isNotNull())


def _accepted_before() -> Column:
    """Rows that apply before their group's cut."""
    return F.col("effective") & (F.col("cut").isNull() | (F.col("seq") < F.col("cut")))


def clean_results(r: DataFrame) -> DataFrame:
    """Outcome of rows in clean groups (every first valid occurrence is accepted)."""
    earlier_valid = F.col("first_valid").isNotNull() & (F.struct("seq", "pos") > F.col("first_valid"))
    success = F.col("in_log") | F.col("effective") | earlier_valid
    skipped = (F.col("pos") > 0) & ~F.col("leader_applies")
    return r.select(
        *FOLD_IN_COLS,
        F.when(skipped, "skipped").when(success, "success").otherwise("failed").alias("status"),
        F.when(~success & ~skipped, F.col("sign_error")).alias("error"),
        F.col("effective").alias("applied"),
        F.when(F.col("effective"), F.col("running")).alias("balance_after"),
    )


# ---- O1 slow path ------------------------------------------------------------------------------------------
FOLD_IN_COLS = [
    "organization_id",
    "group_id",
    "product_id",
    "event_id",
    "event_type",
    "quantity",
    "seq",
    "pos",
    "delta",
    "guarded",
    "sign_error",
    "in_log",
    "repeated",
    "start_balance",
]
FOLD_OUT = T.StructType(
    [
        T.StructField("organization_id", T.IntegerType()),
        T.StructField("group_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("delta", T.LongType()),
        T.StructField("guarded", T.BooleanType()),
        T.StructField("sign_error", T.StringType()),
        T.StructField("in_log", T.BooleanType()),
        T.StructField("repeated", T.BooleanType()),
        T.StructField("start_balance", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("applied", T.BooleanType()),
        T.StructField("balance_after", T.LongType()),
    ]
)


#: Columns of the fold beyond its results: the chunk, the balance it started from, whether the id was
#: taken as recorded by an earlier chunk, and by how much a refused row fell short.
CHUNK_COLS = {"chunk": T.LongType(), "fold_start": T.LongType(), "assumed": T.BooleanType(), "short": T.LongType()}


def _fold_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sequential fold over a partition sorted by (org, group, chunk, seq, pos).

    State: balances of the current chunk's products and the accepted ids among rows that
    repeat in the batch. A unit (same seq) is held back until its last row has arrived,
    because Arrow batches may split it.
    """
    state = {"group": None, "bal": {}, "seen": set()}
    carry: pd.DataFrame | None = None

    def run(df: pd.DataFrame) -> pd.DataFrame:
        n = len(df)
        names = ("organization_id", "group_id", "product_id", "event_id", "seq", "guarded", "sign_error", "repeated", "fold_start", "chunk")
        org, grp, prod, eid, seq, guarded, serr, rep, start, chunk = (df[c].tolist() for c in names)
        in_log = (df["in_log"] | df["assumed"]).tolist()
        invalid = df["delta"].isna().tolist()
        delta = df["delta"].fillna(0).astype("int64").tolist()
        status = [None] * n
        error = [None] * n
        applied = [False] * n
        after = [None] * n
        short = [None] * n
        i = 0
        while i < n:
            g = (org[i], grp[i], chunk[i])
            if g != state["group"]:
                state["group"], state["bal"], state["seen"] = g, {}, set()
            bal, seen = state["bal"], state["seen"]
            j = i + 1
            while j < n and seq[j] == seq[i] and grp[j] == grp[i] and org[j] == org[i]:
                j += 1
            key = (org[i], eid[i])
            if j == i + 1:  # a unit of one row, the usual case
                if in_log[i] or (rep[i] and key in seen):
                    status[i] = "success"
                elif invalid[i]:
                    status[i], error[i] = "failed", serr[i]
                else:
                    p = prod[i]
                    new = bal.get(p, start[i]) + delta[i]
                    if guarded[i] and new < 0:
                        status[i], error[i], short[i] = "failed", S.MSG_INSUFFICIENT, -new
                    else:
                        bal[p] = after[i] = new
                        status[i], applied[i] = "success", True
                        if rep[i]:
                            seen.add(key)
                i = j
                continue
            # unit rows i..j-1, leader at i (pos 0)
            if in_log[i] or key in seen:
                status[i] = "success"
                for k in range(i + 1, j):
                    status[k] = "skipped"
            elif invalid[i]:
                status[i], error[i] = "failed", serr[i]
                for k in range(i + 1, j):
                    status[k] = "skipped"
            else:
                tentative: dict = {}
                ok = True
                for k in range(i, j):
                    if k > i and (in_log[k] or (org[k], eid[k]) in seen):
                        status[k] = "success"
                        continue
                    p = prod[k]
                    cur = tentative.get(p, bal.get(p, start[k]))
                    new = cur + delta[k]
                    if guarded[k] and new < 0:
                        ok, short[k] = False, -new
                        break
                    tentative[p] = new
                    after[k] = new
                    applied[k] = True
                if ok:
                    bal.update(tentative)
                    for k in range(i, j):
                        if applied[k]:
                            status[k] = "success"
                            if rep[k]:
                                seen.add((org[k], eid[k]))
                else:
                    for k in range(i, j):
                        applied[k], after[k] = False, None
                        status[k] = "failed" if k == i else "skipped"
                    error[i] = S.MSG_INSUFFICIENT
            i = j
        out = df.copy(deep=False)
        out["status"] = status
        out["error"] = error
        out["applied"] = applied
        out["balance_after"] = pd.array(after, dtype="Int64")
        out["short"] = pd.array(short, dtype="Int64")
        return out[FOLDED.fieldNames()]

    for pdf in batches:
        if carry is not None and len(carry):
            pdf = pd.concat([carry, pdf], ignore_index=True)
        if not len(pdf):
            continue
        last = (pdf["organization_id"].iat[-1], pdf["group_id"].iat[-1], pdf["seq"].iat[-1])
        tail = (
            (pdf["organization_id"] == last[0]) & (pdf["group_id"] == last[1]) & (pdf["seq"] == last[2])
        ).to_numpy()
        carry = pdf[tail]
        head = pdf[~tail]
        if len(head):
            yield run(head.reset_index(drop=True))
    if carry is not None and len(carry):
        yield run(carry.reset_index(drop=True))


FOLDED = T.StructType(FOLD_OUT.fields + [T.StructField(name, kind) for name, kind in CHUNK_COLS.items()])
GROUP = ["organization_id", "group_id"]
CHUNK = [*GROUP, "chunk"]


def _fold_chunks(rows: DataFrame) -> DataFrame:
    """Fold each (group, chunk) in order, each from its ``fold_start`` balances."""
    columns = [*FOLD_IN_COLS, "chunk", "fold_start", "assumed"]
    keyed = rows.select(*columns).repartition(*CHUNK).sortWithinPartitions(*CHUNK, "seq", "pos")
    return keyed.mapInPandas(_fold_stream, FOLDED)


def fold_slow(rows: DataFrame) -> DataFrame:
    """Sequential fold of the rows from each dirty group's cut on; ``fold_start`` is each
    product's balance at the cut."""
    whole = rows.withColumn("chunk", F.lit(0).cast("long")).withColumn("assumed", F.lit(False))
    return _fold_chunks(whole).select(*FOLD_OUT.fieldNames())


# ---- hot groups: all chunks at once from guessed balances --------------------------------------------------------
#: Rows behind its cut above which a group is folded in chunks, and how often chunks whose guess was
#: off are folded again before their group is folded in one go.
HOT_ROWS = 1 << 20
ROUNDS = 8

#: Stands for a difference of balances without a bound.
FAR = 1 << 62
CHAIN_OUT = "organization_id int, group_id long, chunk long, product_id long, event_id string, wrong boolean, start long, seen boolean"


def _guesses(rows: DataFrame, chunk: int) -> DataFrame:
    """First guesses: a product's balance at a chunk's start as if refused rows took what there was
    (the running sum less its lowest point below zero), and an id as recorded at its first valid row."""
    numbered = rows.withColumn("chunk", F.floor(F.col("seq") / chunk)).withColumnRenamed("fold_start", "base")
    took = F.when(F.col("effective"), F.col("delta")).otherwise(F.lit(0))
    low = F.min(F.when(F.col("effective") & F.col("guarded"), F.col("running")))
    sums = numbered.groupBy(*CHUNK, "product_id", "base").agg(F.sum(took).alias("_sum"), low.alias("_low"))
    earlier = Window.partitionBy(*GROUP, "product_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    debt = F.least(F.lit(0), F.coalesce(F.min("_low").over(earlier), F.lit(0)))
    guess = F.col("base") + F.coalesce(F.sum("_sum").over(earlier), F.lit(0)) - debt
    guesses = sums.select(*CHUNK, "product_id", guess.alias("fold_start"))
    assumed = F.col("repeated") & F.coalesce(F.floor(F.col("first_valid.seq") / chunk) < F.col("chunk"), F.lit(False))
    return numbered.withColumn("assumed", assumed).join(guesses, [*CHUNK, "product_id"])


def _chunk_summaries(folded: DataFrame, bases: DataFrame) -> DataFrame:
    """A row for each product of a chunk: by how much its start may differ from the guess without
    changing a decision (lo <= difference < hi) and its net change; and one for each repeated id."""
    products = folded.groupBy(*CHUNK, "product_id").agg(
        F.max("fold_start").alias("guess"),
        F.coalesce(F.sum(F.when(F.col("applied"), F.col("delta"))), F.lit(0)).alias("net"),
        F.coalesce(-F.min(F.when(F.col("applied") & F.col("guarded"), F.col("balance_after"))), F.lit(-FAR)).alias("lo"),
        F.coalesce(F.min("short"), F.lit(FAR)).alias("hi"),
    )
    ids = folded.where("repeated and not in_log").groupBy(*CHUNK, "event_id").agg(F.max("assumed").alias("assumed"), F.max("applied").alias("accepted"))
    both = products.join(bases, [*GROUP, "product_id"]).unionByName(ids, allowMissingColumns=True)
    return both.select(*CHUNK, "product_id", "event_id", "base", "guess", "net", "lo", "hi", "assumed", "accepted").fillna(0, ["product_id", "base", "guess", "net", "lo", "hi"])


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walk the chunk summaries of each group in order and tell for each what it really starts from.

    A chunk whose guess was off counts on with the end it found, since folds from different starts
    tend to meet; that is only the next guess. Chunks before a group's first wrong one are final."""
    group, chunk, rows = None, None, []
    balance: dict = {}
    seen: set = set()

    def close() -> list[tuple]:
        starts, wrong = [], False
        for r in rows:
            if r.event_id is not None:
                wrong |= bool(r.assumed) != (r.event_id in seen)
                continue
            start = balance.get(r.product_id, r.base)
            off = start - r.guess
            bad = not r.lo <= off < r.hi
            wrong |= bad
            starts.append((r, start, r.guess if bad else start))
        out = [(*group, chunk, int(r.product_id), None, wrong, int(start), None) for r, start, _ in starts]
        ids = [r for r in rows if r.event_id is not None]
        out += [(*group, chunk, None, r.event_id, wrong, None, r.event_id in seen) for r in ids]
        balance.update({r.product_id: begun + r.net for r, _, begun in starts})
        seen.update(r.event_id for r in ids if r.accepted)
        return out

    for pdf in batches:
        out = []
        pdf["event_id"] = pdf["event_id"].astype(object).where(pdf["event_id"].notna(), None)
        for r in pdf.itertuples(index=False):
            at = (int(r.organization_id), int(r.group_id))
            if rows and (at != group or int(r.chunk) != chunk):
                out += close()
                rows = []
            if at != group:
                group, balance, seen = at, {}, set()
            chunk = int(r.chunk)
            rows.append(r)
        yield _chain_frame(out)
    if rows:
        yield _chain_frame(close())


def _chain_frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in CHAIN_OUT.split(", ")])
    return out.astype({"product_id": "Int64", "start": "Int64", "seen": "boolean"})


def fold_hot(rows: DataFrame, chunk: int, rounds: int = ROUNDS) -> DataFrame:
    """``fold_slow`` for groups with very many rows, spread over chunks of ``chunk`` arrival numbers.

    Each round folds the chunks in question in parallel. A group's first wrong chunk starts from
    its true balances in the next round, so every round settles at least one more; groups that are
    not settled after ``rounds`` are folded in one go. ``rows`` also has effective, running and
    first_valid from the fast path."""
    guessed = materialize(_guesses(rows, chunk), "fold-guesses")
    bases = guessed.select(*GROUP, "product_id", "base").distinct()
    pending, results, asked, open_groups = guessed, None, None, None
    for turn in range(rounds):
        folded = materialize(_fold_chunks(pending).withColumn("turn", F.lit(turn)), "fold-chunks")
        fresh = _chunk_summaries(folded, bases)
        if results is None:
            results, summaries = folded, materialize(fresh, "fold-summaries")
        else:
            results = results.unionByName(folded)
            summaries = materialize(summaries.join(asked, CHUNK, "left_anti").unionByName(fresh), "fold-summaries")
        walked = summaries.repartition(*GROUP).sortWithinPartitions(*CHUNK).mapInPandas(_chain, CHAIN_OUT)
        starts = materialize(walked, "fold-starts")
        asked = materialize(starts.where("wrong").select(*CHUNK).distinct(), "fold-wrong")
        if asked.isEmpty():
            open_groups = None
            break
        open_groups = asked.select(*GROUP).distinct()
        moved = starts.where("wrong and product_id is not null").select(*CHUNK, "product_id", F.col("start").alias("fold_start"))
        ids = starts.where("wrong and event_id is not null").select(*CHUNK, "event_id", F.col("seen").alias("assumed"))
        again = guessed.drop("fold_start", "assumed").join(moved, [*CHUNK, "product_id"])
        pending = again.join(ids, [*CHUNK, "event_id"], "left").withColumn("assumed", F.coalesce("assumed", F.lit(False)))
    # of each chunk the last fold holds; balances move by what its start differs from the guess
    last = results.select(*CHUNK, "turn").distinct().groupBy(*CHUNK).agg(F.max("turn").alias("turn"))
    true_starts = starts.where("product_id is not null").select(*CHUNK, "product_id", "start")
    settled = results.join(last, [*CHUNK, "turn"]).join(true_starts, [*CHUNK, "product_id"])
    settled = settled.withColumn("balance_after", F.col("balance_after") + F.col("start") - F.col("fold_start"))
    if open_groups is None:
        return settled.select(*FOLD_OUT.fieldNames())
    rest = fold_slow(rows.join(open_groups, GROUP, "left_semi"))
    return settled.join(open_groups, GROUP, "left_anti").select(*FOLD_OUT.fieldNames()).unionByName(rest)


# ---- the composed operator -----------------------------------------------------------------------------------
def apply_batch(
    events: DataFrame,
    log_ids: DataFrame | None = None,
    start_state: DataFrame | None = None,
    recipe_items: DataFrame | None = None,
    groups: DataFrame | str | None = None,
    unique_ids: bool = False,
    chunk: int = 1 << 16,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """O1+O2+O3: per fold row ``status`` (success / failed / skipped), ``error``, ``applied``
    (newly recorded), ``balance_after``. Leader rows (``pos`` 0) are the batch's rows.

    ``groups="product"`` declares that rows of different products never interact (no
    recipes, ids unique per product) and skips the labelling rounds. Groups with more than
    ``hot_rows`` rows behind their first possible refusal are folded in chunks of ``chunk`` arrival
    numbers, spread over tasks; the outcome is the same.
    """
    rows = expand_units(events, recipe_items)
    rows = annotate(rows, log_ids, start_state, unique_ids=unique_ids)
    by_product = isinstance(groups, str)
    if by_product:
        if recipe_items is not None:
            raise ValueError("recipe cascades need interaction groups")
        rows = rows.withColumn("group_id", F.col("product_id"))
    elif groups is None:
        # The annotated rows feed both the group labelling and the fold: write them once.
        rows = materialize(rows, "fold-rows")
        edges = repeated_id_edges(rows)
        if recipe_items is not None:
            # only dishes that the batch sells tie their components together
            sold = rows.where((F.col("pos") == 0) & (F.col("event_type") == "SALE") & F.col("delta").isNotNull())
            dishes = sold.select("organization_id", F.col("product_id").alias("finished_product_id")).distinct()
            edges = edges.unionByName(recipe_edges(recipe_items.join(dishes, ["organization_id", "finished_product_id"], "left_semi")))
        edges = materialize(edges, "group-edges")
        if edges.limit(1).count() == 0:
            groups = rows.sparkSession.createDataFrame([], "organization_id int, product_id long, group_id long")
        else:
            groups = connected_groups(edges)
    if not by_product:
        rows = rows.join(groups, ["organization_id", "product_id"], "left").withColumn(
            "group_id", F.coalesce("group_id", "product_id")
        )
    judged = fold_fast(rows, cascades=recipe_items is not None, by_product=by_product, chunk=chunk)
    # Before a group's cut nothing has been refused yet, so those rows (all rows of clean
    # groups) are finished by the prefix-sum results; only the suffix is folded in order.
    before = F.col("cut").isNull() | (F.col("seq") < F.col("cut"))
    clean = clean_results(judged.filter(before))
    accepted_before = judged.filter(F.col("cut").isNotNull() & _accepted_before())
    suffix = judged.filter(~before)
    if not by_product:
        pre = accepted_before.groupBy("organization_id", "product_id").agg(F.sum("delta").alias("_pre"))
        suffix = suffix.join(pre, ["organization_id", "product_id"], "left")
    suffix = suffix.withColumn("fold_start", F.col("start_balance") + F.coalesce("_pre", F.lit(0)))
    if not unique_ids:
        # ids recorded before the cut are no-ops when they repeat after it
        done = accepted_before.select(*KEY).distinct().withColumn("_done", F.lit(True))
        suffix = suffix.join(done, KEY, "left").withColumn("in_log", F.col("in_log") | F.coalesce("_done", F.lit(False)))
    sizes = judged.filter(~before).groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.where(F.col("n") > hot_rows).select(*GROUP)
    if hot.isEmpty():
        return clean.unionByName(fold_slow(suffix))
    hot = materialize(hot, "hot-groups")
    spread = fold_hot(suffix.join(hot, GROUP, "left_semi"), chunk)
    return clean.unionByName(fold_slow(suffix.join(hot, GROUP, "left_anti"))).unionByName(spread)


def final_balances(results: DataFrame, start_state: DataFrame | None = None) -> DataFrame:
    """New projection rows for every product the batch touched: start + applied deltas."""
    touched = results.groupBy("organization_id", "product_id").agg(
        F.max("start_balance").alias("start_balance"),
        F.sum(F.when(F.col("applied"), F.col("delta")).otherwise(0)).alias("applied_delta"),
    )
    return touched.select(
        "organization_id",
        "product_id",
        (F.col("start_balance") + F.col("applied_delta")).cast("bigint").alias("quantity"),
    )


def accepted_events(results: DataFrame) -> DataFrame:
    """The newly recorded events (leader and cascade rows), ready to append to the log."""
    return results.filter("applied").select(
        "organization_id",
        "product_id",
        "event_id",
        "event_type",
        F.col("delta").cast("int").alias("quantity"),
        "seq",
        "pos",
    )
