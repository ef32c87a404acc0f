"""Every registered operator query agrees with its DuckDB SQL on two table sizes."""

import pytest

from scripts.oracle_check import digest
from stockroom.llm import queries
from tests.conftest import SF_MID, SF_SMALL


def agree(df, con, sql):
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(names, want)[0]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_small(spark, duck_small, name):
    agree(queries.QUERIES[name](spark, SF_SMALL), duck_small, queries.ORACLE[name])


@pytest.mark.parametrize("name", ["op2_quality_rules", "op4_licenses", "op5_minhash", "op6_line_dedup", "op10_embeddings", "op11_decontaminate", "op12_filter_audit", "op13_ranked_search"])
def test_mid(spark, duck_mid, name):
    agree(queries.QUERIES[name](spark, SF_MID), duck_mid, queries.ORACLE[name])


def test_each_operator_has_one_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
