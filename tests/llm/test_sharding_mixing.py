import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from stockroom.llm import mixing, sharding
from stockroom.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_published_loop():
    keys = np.array([0, 1, 7, 10**12, 2**63 - 1, -5, -1], np.int64)
    for n in (1, 2, 40, 41, 1000):
        assert sharding.jump_hash(keys.view(np.uint64), n).tolist() == [jump(int(k) % 2**64, n) for k in keys]


def test_growing_moves_rows_only_into_the_new_shard(spark):
    rows = QUERIES["op7_sharding"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert all(r.grown_shard in (r.shard, 40) for r in rows)
    assert all(r.shard == jump(r.doc_id, 40) and r.grown_shard == jump(r.doc_id, 41) for r in rows)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 16 for r in rows)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_sharding_of_odd_rows(odd_docs, no_docs):
    rows = sharding.shard_documents(odd_docs, 3).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 2} == {(16, 0)}
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(3) for i in range(sum(r.shard == s for r in rows))]
    assert sharding.shard_documents(no_docs, 3).count() == 0


def water_filled(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing again and again, as the contract words it."""
    names = sorted(sizes)
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    rest, fixed = float(sum(sizes.values())), {}
    while True:
        free = [n for n in names if n not in fixed]
        share = {n: rest * w[n] / sum(w[m] for m in free) for n in free}
        over = [n for n in free if share[n] > cap * sizes[n] * (1 + 1e-12)]
        if not over:
            return fixed | share
        for n in over:
            fixed[n] = float(cap * sizes[n])
            rest -= fixed[n]


def test_targets_equal_repeated_sharing(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 3}, {"a": 1, "b": 1, "c": 1, "d": 500}, {"a": 7}, {"a": 0, "b": 5}):
        got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "key string, source_size long"))
        for r in got.collect():
            assert abs(r.target - water_filled(sizes)[r.key]) < 1e-6 * (1 + r.target), (sizes, r)


def test_schedule_serves_quotas_evenly(spark):
    targets = spark.createDataFrame([("a", 5000, 2500.0), ("b", 900, 2700.0), ("c", 10, 7.0)], "key string, source_size long, target double")
    rows = mixing.schedule(targets, 100).orderBy("slot").collect()
    taken = {}
    for r in rows:
        taken[r.key] = taken.get(r.key, 0) + r.words
    assert taken == {"a": 2500, "b": 2700, "c": 7}
    assert [r.rank for r in rows if r.key == "a"] == list(range(25))
    first = [r.key for r in rows[:20]]  # low discrepancy: no source waits for the other's end
    assert 7 <= first.count("a") <= 13 and 7 <= first.count("b") <= 13


def test_mix_of_odd_rows(odd_docs, no_docs):
    rows = mixing.mix_documents(odd_docs, block_words=64).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.taken <= 3 * r.size for r in rows)
    targets = {(r.source_size, r.target) for r in rows}
    assert abs(sum(t for _, t in targets) - sum(r.size for r in rows)) < 1e-6
    assert mixing.mix_documents(no_docs).count() == 0
    assert mixing.draw_mix(odd_docs).columns == odd_docs.columns
    assert mixing.draw_mix(no_docs).count() == 0


def test_a_rerun_takes_the_same(odd_docs):
    once, again = (sorted(map(tuple, mixing.mix_documents(d).collect()), key=str) for d in (odd_docs, odd_docs.repartition(7)))
    assert once == again


def test_rows_of_one_id_are_drawn_each(spark):
    """Each source keeps its own share, also where rows have one id or none and are repeated."""
    rows = [(None if i % 3 else 7, f"{s} {i % 25 if s == 'b' else i} " + "word " * 8, s) for s, n in (("a", 40), ("b", 90), ("c", 200)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {r.source: r.n for r in docs.groupBy("source").agg({"text": "count"}).withColumnRenamed("count(text)", "n").collect()}
    want = dict.fromkeys(sizes, 0)
    for r in mixing.mix_documents(docs, block_words=64).collect():
        source = next(s for s, n in sizes.items() if n * 10 == r.source_size)
        want[source] += -(-r.taken // r.size)
    got = {r.source: r["count"] for r in mixing.draw_mix(docs, block_words=64).groupBy("source").count().collect()}
    assert got == want and got["c"] < 200 < 3 * got["a"]


def test_rows_of_one_id_are_numbered_by_many_tasks(spark):
    docs = spark.createDataFrame([(5, f"text {i}") for i in range(1000)] + [(None, f"text {i}") for i in range(1000)], "doc_id long, text string")
    rows = sharding.shard_documents(docs, 4)
    slots = {}
    for r in rows.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) <= 2
    part = F.shiftright(F.crc32(F.col("text").cast("binary")), 24)
    assert docs.where("doc_id = 5").select(part.alias("p")).distinct().count() > 200


def test_mix_numbers_rows_of_one_id_in_many_ranges(spark):
    """A third of all rows has one id, another third none, many of them equal; the order stays that of
    one window over the source."""
    rows = [((5, None, i)[i % 3], "word " * (i % 40 + 1), "a" if i % 5 else None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        order = docs.select(F.lit("0a").alias("key"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("_order"), "doc_id", F.length("text").alias("size"), F.lit(None).cast("binary").alias("digest"))
        runs = mixing._runs(order.where("doc_id = 5 and size = 5"))
        assert runs.select("_part").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
        got = mixing.mix_documents(docs, block_words=64)
        got = sorted(((r.doc_id, r.size, r.source_size, r.taken) for r in got.collect()), key=str)
    finally:
        spark.conf.unset(coalesce)
    # the same streams, laid out one after another
    quota, want = {}, []
    sizes = {s: sum(i % 40 + 1 for i in range(3000) if ("a" if i % 5 else None) == s) for s in ("a", None)}
    targets = spark.createDataFrame([("0a", sizes["a"]), ("1", sizes[None])], "key string, source_size long")
    for r in mixing.schedule(mixing.source_targets(targets), 64).collect():
        quota.setdefault(r.key, {}).setdefault(r.block, []).append(r.words)
    for source, key in (("a", "0a"), (None, "1")):
        mine = [(hashlib.md5(f"0:{'null' if d is None else d}".encode()).hexdigest(), d, len(t.split())) for d, t, s in rows if s == source]
        at = 0
        for _, d, size in sorted(mine, key=lambda x: (x[0], x[2])):
            taken = sum(max(0, min(at + size, b * 64 + w) - max(at, b * 64)) for b in range(at // 64, (at + size - 1) // 64 + 1) for w in quota[key].get(b, []))
            want.append((d, size, sizes[source], taken))
            at += size
    assert got == sorted(want, key=str)
