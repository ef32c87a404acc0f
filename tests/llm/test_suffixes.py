import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockroom.llm import suffixes
from stockroom.llm.queries import QUERIES
from tests.conftest import SF_MID


def brute(rows, length=100):
    """Removal by a set of all strings seen so far."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        covered, end = bytearray(len(data)), 0
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                for x in range(max(p, end), p + length):
                    covered[x] = 1
                end = p + length
            seen.add(data[p : p + length])
        spans = sum(1 for k in range(len(data)) if covered[k] and not (k and covered[k - 1]))
        out[doc] = (len(data), sum(covered), spans, hashlib.sha256(bytes(c for c, gone in zip(data, covered) if not gone)).hexdigest())
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@settings(deadline=None, max_examples=60)
@given(st.binary(min_size=1, max_size=300).map(lambda b: bytes(97 + x % 3 for x in b) + b[:5]))
def test_suffix_array_and_prefixes(text):
    order = suffixes.suffix_array(np.frombuffer(text, np.uint8), 1 << 12)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    shared = suffixes.common_prefixes(np.frombuffer(text, np.uint8), order)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :], text[order[k] :]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == n


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(3)
    base = "".join(dice.choice("abcdéfghij ") for _ in range(400))
    out = [base, base[50:260], "x" * 500, None, "", "ab" * 300, base[:130] + "zz" + base[100:399], "x" * 99, "x" * 100, "q" + base + "\0" * 250, "\0" * 120 + base[120:300], base + base]
    for _ in range(40):
        a = dice.randrange(300)
        out.append("".join(dice.choice("abcdefghij ") for _ in range(dice.randrange(60))) + base[a : a + dice.randrange(50, 400)])
    return list(enumerate(out))


@pytest.mark.parametrize("hot", [suffixes.HOT_CHUNKS, 1])
def test_small_texts_equal_brute_force(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_CHUNKS", hot)  # 1: guides are split over shards and merged
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert found(suffixes.digests(suffixes.remove_repeats(docs))) == brute(texts)


def test_documents_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    assert found(QUERIES["op1_suffix_dedup"](spark, SF_MID)) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = suffixes.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert [r.n_removed for r in rows if r.doc_id == 1] == [0, 0, 0]
    assert {r.n_spans for r in rows if r.doc_id == 5} == {1}
    assert {(r.n_removed, r.n_spans) for r in rows if r.doc_id == 9} == {(2999, 1)}
    assert suffixes.remove_repeats(no_docs).count() == 0
