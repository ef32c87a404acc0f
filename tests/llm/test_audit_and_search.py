"""Decontamination, filter audit and ranked search against brute force and on odd rows."""

import hashlib
import math
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from stockroom.llm import decontaminate, filter_audit, ranked_search
from stockroom.llm.itemwords import item_blocks, text_bytes, word_keys

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PLAIN = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


# ---- words --------------------------------------------------------------------------------------
def test_word_keys_are_the_words():
    texts = ["Ab aB, é-É", None, "", "end", "start x" + "y" * 9000 + " x" + "y" * 8999 + "z", "…—", "a\x00b"]
    data, bounds = text_bytes(pa.array(["skipped", *texts]).slice(1))
    keys, starts, ends = word_keys(data, bounds)
    said = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    want = [w for t in texts for w in low(t)]
    assert [low(w)[0] for w in said] == want
    seen = {}
    assert all(seen.setdefault(w, k) == k for w, k in zip(want, keys.tolist()))
    assert len(set(seen.values())) == len(seen)
    assert [len(x) for x in word_keys(*text_bytes(pa.array([], pa.string())))] == [0, 0, 0]


def test_item_blocks_are_bounded(spark):
    items = spark.createDataFrame([(i, "x" * 100) for i in range(20)] + [(99, "y" * 5000), (None, None)], "item_id long, text string")
    blocks = list(item_blocks(items, 1000))
    assert sorted(i for ids, _ in blocks for i in ids if i is not None) == [*range(20), 99]
    assert all(len(ids) == 1 or sum(len(t.as_py()) + 64 for t in texts) <= 1000 for ids, texts in blocks)
    assert list(item_blocks(items.where("false"), 1000)) == []


# ---- FM-index -----------------------------------------------------------------------------------
def test_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    for size in (3, 5, 40):
        symbols = rng.integers(1, size, 700)
        symbols[rng.choice(700, 20, replace=False)] = decontaminate.END
        symbols[300:420] = symbols[100:220]
        symbols[500:600] = 1
        symbols[-1] = decontaminate.END
        order = decontaminate.suffix_order(symbols, size)
        assert sorted(order.tolist()) == list(range(700))
        suffix = lambda i: [(int(s), k if s == 0 else 0) for k, s in enumerate(symbols[i:], i)][: 1 + int(np.argmax(symbols[i:] == 0))]
        told = [suffix(i) for i in order]
        assert told == sorted(told)
        index = decontaminate.Index(symbols, size)
        assert sorted(index.locate(np.arange(700)).tolist()) == list(range(700))
        seen, rank = index.before.read(np.arange(700))
        assert seen.tolist() == symbols[order - 1].tolist()
        assert rank.tolist() == [int((seen[:i] == seen[i]).sum()) for i in range(700)]


def brute_passages(texts, items, width=10):
    windows = {}
    for name, text in items:
        said = low(text)
        for i in range(max(1, len(said) - width + 1)):
            if said:
                windows.setdefault(tuple(said[i : i + width]), set()).add("" if name is None else str(name))
    out = []
    for text in texts:
        said, hit, names = low(text), set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(said) - length + 1):
                if (found := windows.get(tuple(said[i : i + length]))) is not None:
                    hit |= set(range(i, i + length))
                    names |= found
        out.append((len(said), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("index_words, block_bytes", [(1 << 20, 1 << 20), (16, 1 << 20), (1 << 20, 300)])
def test_passages_against_brute_force(spark, monkeypatch, index_words, block_bytes):
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", index_words)
    rng = np.random.default_rng(11)
    say = lambda n, k=12: " ".join(f"w{i}" for i in rng.integers(0, k, n))
    items = [(1, say(25)), (2, say(10)), (10, say(3)), (3, "w1"), (3, say(14)), (None, say(12)), (4, ""), (5, None), (6, "Été W2 w3"), (7, say(40, 2))]
    texts = [say(int(n), 6) for n in rng.integers(0, 60, 30)] + [None, "", "...", "été w2, W3 ÉTÉ", say(200, 2), items[0][1].upper() + " w0 " + items[1][1], items[0][1], items[0][1]]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(3)
    found = decontaminate.find_passages(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.contamination(found).collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts, items)
    for row in found.collect():
        for s in row.spans:
            part = row.text.encode()[s.from_byte : s.to_byte].decode()
            assert low(part) == low(row.text)[s.first_word : s.last_word + 1]
        assert all(a.last_word + 1 < b.first_word for a, b in zip(row.spans, row.spans[1:]))


def test_a_search_sees_only_whole_windows(spark):
    said = " ".join(f"t{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"start {said} end"), (2, said.replace("t5", "u5")), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, said)], "item_id long, text string")
    assert sorted(map(tuple, decontaminate.without_passages(docs, bench).collect())) == [(1, "start  end"), (2, said.replace("t5", "u5")), (3, None)]


def test_passages_of_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "Three four"), (2, None)], "item_id long, text string")
    rows = decontaminate.contamination(decontaminate.find_passages(odd_docs, bench)).collect()
    assert len(rows) == odd_docs.count()
    assert [(r.n_hit, r.n_items) for r in rows if r.contaminated] == [(2, 1), (2, 1)]
    empty = hashlib.sha256(b"").hexdigest()
    clean = decontaminate.contamination(decontaminate.find_passages(odd_docs, bench.where("false"))).collect()
    assert {(r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in clean} == {(0, 0, empty, False)}
    assert sorted(r.n_words for r in clean) == sorted(r.n_words for r in rows)
    assert decontaminate.find_passages(no_docs, bench).count() == 0


# ---- filter audit -------------------------------------------------------------------------------
def brute_audit(docs, labels):
    firsts, good, toxic = {}, set(), set()
    for doc, text, _ in docs:
        if doc is not None:
            firsts[text or ""] = min(doc, firsts.get(text or "", doc))
    for doc, quality, poison in labels:
        good |= {doc} if quality == 1 and doc is not None else set()
        toxic |= {doc} if poison == 1 and doc is not None else set()
    rows = []
    for doc, text, lang in docs:
        text = text or ""
        said = PLAIN.findall(text)
        fails = {
            "A": len(said) < 100,
            "B": 100 * len(set(said)) < 80 * len(said),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and doc > firsts[text],
        }
        rows.append((lang or "", fails, doc in good, doc in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                failing = [r for r in here if r[1][f]]
                only = [r for r in failing if sum(r[1].values()) == 1]
                out[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), len(only), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for f in "ABCDE":
            total = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == f)
            for (p, o, s), v in out.items():
                if p == part and o[s - 1] == f:
                    v.append(total)
    return {k: tuple(v) for k, v in out.items()}


def test_audit_against_brute_force(spark):
    rng = np.random.default_rng(8)
    pool = [" ".join(f"w{i}" for i in rng.integers(0, k, n)) + end for k in (60, 900) for n in (0, 20, 99, 100, 140) for end in ("", " #1", " LOUD" * 40)]
    pool += [None, "", " \t\n", "É" * 50 + "A" * 5, "É" * 45 + "A" * 5, "\x85  x"]
    docs = [(int(i), pool[int(p)], lang) for i, p, lang in zip(rng.integers(0, 60, 150), rng.integers(0, len(pool), 150), rng.choice(np.array(["a", "b", "", None], object), 150))]
    docs += [(None, pool[3], "a"), (None, pool[3], "a"), (3, pool[4], "b"), (3, pool[4], "b"), (3, pool[4], None)]
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(0, 60, 2)] + [(1, None, 1), (1, 1, None), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, 7, 8) for d in docs], "doc_id long, text string, lang string, cell int, good int")
    got = filter_audit.audit_filters(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == brute_audit(docs, labels) and len(got) == 600 * 3


def test_audit_of_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd, none = (d.withColumn("lang", d["source"]) for d in (odd_docs, no_docs))
    assert filter_audit.audit_filters(none, labels).count() == 0
    rows = filter_audit.audit_filters(odd, labels).collect()
    assert {r.part for r in rows} == {"", "a", "b"} and {r.good_lost + r.toxic_lost for r in rows} == {0}


# ---- ranked search ------------------------------------------------------------------------------
def brute_search(docs, items, top=10):
    counted = [(doc, Counter(low(text))) for doc, text in docs]
    counted = [(doc, c, c.total()) for doc, c in counted if c]
    n_docs, all_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(low(text)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("cells, block_bytes", [(1 << 21, 4 << 20), (1, 200)])
def test_search_against_brute_force(spark, monkeypatch, cells, block_bytes):
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block_bytes)
    rng = np.random.default_rng(2)
    say = lambda n, k=40: " ".join(f"W{min(int(i), k)}" for i in rng.geometric(0.1, n))
    docs = [(i % 70, say(int(n))) for i, n in enumerate(rng.integers(0, 40, 120))]
    docs += [(i, docs[5][1]) for i in range(200, 230)] + [(None, docs[5][1]), (None, None), (9, ""), (9, "—"), (300, "É w1")]
    items = [(i, say(12)) for i in range(8)] + [(8, docs[5][1]), (8, docs[5][1]), (8, "é W3"), (None, "w2"), (9, None), (10, ""), (11, "nowhere"), (12, say(60))]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, n int, score int").repartition(3)
    asked = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, rank int")
    got = sorted(map(tuple, ranked_search.search(frame, asked).collect()), key=str)
    assert got == brute_search(docs, items)


def test_search_of_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "three"), (2, None)], "item_id long, text string")
    assert ranked_search.search(no_docs, items).count() == 0
    assert ranked_search.search(odd_docs, items.where("false")).count() == 0
    assert [(r.item_id, r.rank, r.doc_id) for r in ranked_search.search(odd_docs, items).orderBy("rank").collect()] == [(1, 1, 1), (1, 2, 1)]


def test_shared_sets_are_computed_once():
    rng = np.random.default_rng(4)
    common = [np.sort(rng.choice(50, 12, replace=False)) for _ in range(4)]
    items = [np.unique(np.concatenate([common[i % 4], rng.integers(50, 300, 5)])) for i in range(60)] + [np.zeros(0, np.int64)]
    sharing = ranked_search.Sharing(items, 300)
    terms = rng.integers(0, 9, (300, 7))
    want = np.array([terms[t].sum(0) for t in items])
    assert (sharing.scores(terms) == want).all()
    plain = sum(len(t) - 1 for t in items if len(t))
    shared = len(sharing.left) + sum(max(0, n - 1) for n in np.diff(sharing.starts))
    assert shared < 0.6 * plain
    assert all((sharing.left[a:b] < 300 + a).all() and (sharing.right[a:b] < 300 + a).all() for a, b in sharing.levels)
