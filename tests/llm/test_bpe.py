import json
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from stockroom.llm import bpe
from stockroom.llm.queries import QUERIES
from tests.conftest import SF_SMALL

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(RANKS)), bpe.Splitter(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec[0].ranks, special_tokens={})


def test_ids_equal_the_library(codec, library):
    own, split = codec
    dice = random.Random(1)
    letters = "abé ñ'srtve ll  \n\t　漢字1234²Ⅷ!?-\U0001f600\U0001d400\x1c\x85\U00013461"
    texts = ["", "a" * 3000, " " * 1000 + "a", "<|endoftext|> ab", "I'll don't 'S 's", "ab" * 900 + "!" * 1000, "\U0001d400\U0001d401 𠀀 a²³ Ⅷ٣"]
    texts += ["".join(dice.choice(letters) for _ in range(dice.randint(1, 200))) for _ in range(300)]
    ids = own.ids_of([split(t) for t in texts])
    for text, got in zip(texts, ids):
        assert np.frombuffer(got, "<u4").tolist() == library.encode_ordinary(text)
    assert [b.decode() for b in own.decode(ids)] == texts


def test_both_ways_to_contract_agree(codec):
    own, _ = codec
    words = ["thethethethe" * 5, "a" * 300, "éàü" * 40, "zqxjk" * 30]
    assert own._contract([w.encode() for w in words]) == [own._contract_long(w.encode()) for w in words]


def test_a_round_has_one_row_of_each_match(codec, tmp_path):
    own, _ = codec
    words = [b"thethethethe" * 5, b"ab" * 150, "éàü".encode() * 40, b"zqxjk", b"jq", b"qz" * 7]
    own.db.execute("pragma enable_profiling='json'")
    own.db.execute(f"pragma profiling_output='{tmp_path}/profile.json'")
    try:
        ids = own._contract(words)
        profile = (tmp_path / "profile.json").read_text()
    finally:
        own.db.execute("pragma disable_profiling")

    def rows(nodes):
        return [n["intermediate_rows"] for n in nodes if n["type"] == "RECURSIVE_CTE"] + [r for n in nodes for r in rows(n.get("children", []))]

    assert ids == [own._contract_long(w) for w in words]
    assert rows(json.loads(profile)["operator"]) == [sum(len(w) - len(x) // 4 + 1 for w, x in zip(words, ids))]


def test_long_sequences_are_decoded_in_parts(codec, monkeypatch):
    own, split = codec
    text = "some words and other words, " * 50
    ids = own.ids_of([split(text), split("x")])
    monkeypatch.setattr(bpe, "QUERY_IDS", 17)
    assert own.decode([ids[0], b"", ids[1]]) == [text.encode(), b"", b"x"]


def test_query_equals_the_library(spark, library):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in QUERIES["op9_bpe"](spark, SF_SMALL).collect():
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows_round_trip(odd_docs, no_docs):
    rows = bpe.encode_documents(odd_docs, RANKS, public_tokenizers.PATTERN)
    texts = sorted((r.text or "") for r in odd_docs.collect())
    assert sorted(bytes(r.decoded).decode() for r in rows.collect()) == texts
    assert sorted(bytes(r.decoded).decode() for r in bpe.decode_documents(rows, RANKS).collect()) == texts
    assert bpe.encode_documents(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0
