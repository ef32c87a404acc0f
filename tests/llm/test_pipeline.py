"""Each stage of the pipeline, on its own input, against the operator's SQL or the library."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

from pyspark.sql import functions as F

import corpus_pipeline
from stockroom.llm import bpe
from stockroom.llm.queries import ORACLE
from tests.conftest import SF_SMALL
from tests.llm.conftest import duck_over


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input path, output rows) of each stage."""
    folder, out = tmp_path_factory.mktemp("pipeline"), {}
    path = f"{SF_SMALL}/documents.parquet"
    for name, stage in corpus_pipeline.STAGES:
        result = str(folder / name)
        stage(spark, spark.read.parquet(path), SF_SMALL).write.parquet(result)
        out[name] = (path, spark.read.parquet(result))
        path = result
    return out


def judged(path, query):
    files = path if path.endswith(".parquet") else path + "/*.parquet"
    res = duck_over(documents=files).execute(ORACLE[query])
    names = [d[0] for d in res.description]
    return [dict(zip(names, r)) for r in res.fetchall()]


def test_columns_and_order(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "source_mix", "bpe"]
    columns = spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    assert all(out.columns == columns for _, out in list(stages.values())[:-1])


def test_quality_rules(stages):
    path, out = stages["quality_rules"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(r["doc_id"] for r in judged(path, "op2_quality_rules") if r["kept"])


def test_line_dedup(stages):
    path, out = stages["line_dedup"]
    want = {r["doc_id"]: r["text"] for r in judged(path, "op6_line_dedup") if r["n_removed"] == 0 or r["text"].strip()}
    assert {r.doc_id: r.text for r in out.collect()} == want
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_near_dedup(stages):
    path, out = stages["near_dedup"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(r["doc_id"] for r in judged(path, "op5_minhash") if r["kept"])


def test_source_mix(stages):
    path, out = stages["source_mix"]
    want = sorted(r["doc_id"] for r in judged(path, "op8_mixing") for _ in range(-(-r["taken"] // max(r["size"], 1))))
    assert sorted(r.doc_id for r in out.collect()) == want


def test_bpe(spark, stages):
    path, out = stages["bpe"]
    ranks = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in spark.read.parquet(path).collect():
        ids = library.encode_ordinary(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()) == sorted(want)


def test_run_applies_all_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages["bpe"][1].collect()))


CLASHING = ("_id", "_md5", "_gone", "_digest", "_n", "_row", "_copies", "_rows", "_equal", "_key", "_part", "_order", "_start", "_times", "_copy", "_cell", "_one", "n_lines", "n_removed", "size", "x1")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_columns_named_like_inner_ones_come_back(spark, odd_docs, no_docs, name, stage):
    docs = odd_docs.drop("size").withColumns({c: F.concat(F.lit(c), F.coalesce("source", F.lit("-"))) for c in CLASHING})
    docs = docs.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    kept = stage(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    for r in kept.collect():
        own = r.source if r.source is not None else "-"
        assert r["n_lines"] == "n_lines" + own and r["_id"] == "_id" + own and r["_copies"] == "_copies" + own
    assert stage(spark, docs.where("false"), SF_SMALL).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_run_on_odd_and_repeated_rows(spark, odd_docs, tmp_path, empty):
    docs = odd_docs.unionByName(odd_docs).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    docs.where(F.lit(not empty)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(rows) == 0 if empty else {r.doc_id for r in rows} >= {1}
    for r in rows:
        assert r.n_tokens > 0 and len(r.ids_sha256) == 64
