"""Quality rules, license scan, line and near-duplicate removal on odd and planted rows."""

import numpy as np

from stockroom.llm import licenses, lines, minhash, quality
from stockroom.llm.components import components
from tests.conftest import SF_MID


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (4, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 10)
    assert [r.kept for r in rows if r.doc_id == 1 and r.n_words == 10] == [True, True]
    assert quality.score_documents(no_docs, labels).count() == 0
    none = quality.score_documents(odd_docs, labels.where("false")).collect()
    assert {r.score_micro for r in none} == {0} and [r.kept for r in none if r.n_words == 10] == [True, True]
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.kept for r in rows)


def test_quality_keeps_clean_and_drops_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.score_documents(docs, labels).join(labels, "doc_id").where("not base_failed")
    clean = judged.where("quality = 1").agg({"kept": "min"}).first()[0]
    assert clean is True
    assert judged.where("quality = 0 and kept").count() <= 0.2 * judged.where("quality = 0").count()


def test_licenses(spark, odd_docs, no_docs):
    long_notice = "Permission is hereby granted, free of charge, to any body obtaining a copy of this software and associated documentation files"
    rows = licenses.scan_licenses(docs_of(spark, ["Released under the MIT License. cc-by-nc CC BY NC", long_notice, "Licensed under the GNU General Public License, version 3.", "under the mit licence", "UNDER THE MIT LİCENSE"])).orderBy("doc_id").collect()
    assert (rows[0].n_base, rows[0].first_word, rows[0].last_word, rows[0].base_labels, rows[0].score) == (3, 1, 8, "cc-by-nc,mit", 1.0)
    assert (rows[1].n_base, rows[1].first_word, rows[1].labels) == (0, None, "mit") and 0.8 <= rows[1].score < 1
    assert (rows[2].base_labels, rows[2].labels) == ("", "gpl-3")
    assert (rows[3].labels, rows[3].score, rows[4].n_base) == ("", 0.0, 0)
    assert licenses.scan_licenses(odd_docs).count() == odd_docs.count()
    assert licenses.scan_licenses(no_docs).count() == 0


def test_lines(odd_docs, no_docs):
    rows = lines.dedup_lines(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id in (7, 8)}
    assert (by[7].n_removed, by[8].n_removed, by[8].text) == (0, 3, "zero\n\nlast")
    assert {(r.text, r.n_lines) for r in rows if r.doc_id == 2} == {(None, 0)}
    assert {r.size for r in rows} == {"x", None}
    assert lines.dedup_lines(no_docs).count() == 0
    assert lines.without_later_lines(odd_docs).columns == odd_docs.columns


def test_lines_within_one_text_and_blank_lines(spark):
    (row,) = lines.dedup_lines(docs_of(spark, ["a 1\nb 2\nc 3\n\na 1\n \nb 2\nc 3\nd 4"])).collect()
    assert (row.text, row.n_removed) == ("a 1\nb 2\nc 3\n\nd 4", 4)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = minhash.near_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id not in (None, 1)}
    assert found[2] == (0, 2, True) and found[3] == (0, 3, True) and found[6] == (0, 6, True)
    assert found[4][1:] == (4, True) and found[5][1:] == (4, False)
    assert minhash.near_groups(no_docs).count() == 0
    assert minhash.keep_first(odd_docs).columns == odd_docs.columns


def test_a_large_family_in_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(90):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 12), replace=False):
            words[at] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(words))
    sets = [{tuple(w[i : i + 5]) for i in range(116)} for w in (t.split() for t in texts)]
    group = list(range(90))
    for a in range(90):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = sorted((group[a], group[b]), reverse=True)
                group = [new if g == old else g for g in group]
    assert len(set(group)) > 1
    got = {r.doc_id: r.component_id for r in minhash.near_groups(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(90)] == group


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 120)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_a_group_stays(spark):
    said = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, said(1), "b"), (1, said(1), "a"), (1, said(1), "a"), (1, said(2), "a"), (0, said(2) + " end", "a"), (None, said(1) + " end", "a")]
    rows += [(None, said(3), "a"), (None, said(3), "a"), (None, said(3) + " end", "a"), (5, "", "a"), (5, "", "a"), (None, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(map(tuple, minhash.keep_first(docs).collect()), key=str)
    third = [r for r in got if r[1] and r[1].startswith("w3x")]
    assert len(third) == 1 and third[0][0] is None
    assert sorted([(0, said(2) + " end", "a"), (1, said(1), "a"), (5, "", "a"), (5, "", "a"), (None, None, "a"), *third], key=str) == got


def test_notices_that_differ_by_a_word(spark):
    said = [
        ("licensed under the GNU Lesser General Public License version 3", "lgpl-3"),
        ("licensed under the GNU Affero General Public License version 3", "agpl-3"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", "agpl"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
        ("This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "cc-by-sa"),
        ("This work is licensed under a Creative Commons Attribution NonCommercial NoDerivatives 4.0 International License", "cc-by-nc-nd"),
        ("licensed under the gnu frobnicated general public license version 3", ""),
        ("This work is licensed under a Creative Commons Attribution Weekendsonly 4.0 International License", ""),
        ("licensed under the gnu general public license version 3. This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by,gpl-3"),
    ]
    rows = licenses.scan_licenses(docs_of(spark, [t for t, _ in said])).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == [label for _, label in said]
    assert all(r.score == (1.0 if r.labels else 0.0) for r in rows)


def test_whole_license_texts(spark):
    whole = next(t for t, label in licenses.TEMPLATES if label == "mit" and len(t.split()) > 62)
    words = whole.split()
    changed = " ".join(w if i % 40 else "changed" for i, w in enumerate(words))
    half = " ".join(words[30:90])
    rows = licenses.scan_licenses(docs_of(spark, [whole.upper(), changed, half, f"before {whole} between {whole} after"])).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["mit", "mit", "", "mit"]
    assert rows[0].score == 1.0 and 0.8 <= rows[1].score < 1 and rows[3].score == 1.0
    long = (" ".join(f"w{i}" for i in range(300)), "own")
    (row,) = licenses.scan_licenses(docs_of(spark, ["x " + long[0]]), templates=(long,)).collect()
    assert (row.labels, row.score) == ("own", 1.0)


def test_many_rows_without_id_meet_one_to_one(spark):
    said = lambda k, end="": " ".join(f"w{k}x{i}" for i in range(40)) + end
    rows = [(None, said(i % 50, " end" if i % 3 else "")) for i in range(300)] + [(7, said(i)) for i in range(60)] + [(None, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = []
    texts_of = minhash.texts_of

    def counted(docs, members):
        out = texts_of(docs, members)
        nodes.append((members.count(), out.count(), out.select("node").distinct().count()))
        return out

    minhash.texts_of = counted
    try:
        got = minhash.near_groups(docs).collect()
    finally:
        minhash.texts_of = texts_of
    assert nodes == [(nodes[0][0],) * 3] and nodes[0][0] >= 100
    assert len(got) == len(rows) and {r.component_id for r in got if r.n_shingles and r.doc_id is None} == {7}
    kept = minhash.keep_first(docs)
    assert kept.where("text like 'w%'").count() == 60
