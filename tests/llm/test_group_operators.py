"""Operators over many documents, against brute force."""

import os
import re
import subprocess
import sys
import textwrap
import tracemalloc
import zlib
from collections import Counter, defaultdict
from unittest import mock

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from riskloom.llm import ann, jaccard_join, license_scan, packing, scratch, secret_scan, sharding
from riskloom.llm.components import components
from tests.compare import connect, difference
from tests.llm.conftest import words


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall("[^\x20\x09-\x0d]+", low)
    return frozenset(tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))) if found else (
        frozenset())


def near_groups(rows):
    """doc_id, n_shingles, component_id by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for x, (doc, _) in zip(label, rows, strict=True):
        if doc is not None:
            least[x] = min(doc, least.get(x, doc))
    return Counter((doc, len(s), least.get(x)) for (doc, _), s, x in zip(
        rows, sets, label, strict=True))


def found_groups(docs):
    return Counter(map(tuple, jaccard_join.near_groups(docs).collect()))


@pytest.mark.parametrize("docs", ["edge", "small", "empty"])
def test_jaccard_join(request, docs):
    docs = request.getfixturevalue(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found_groups(docs) == near_groups(rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    named = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(named) == sorted({c for d, _, c in near_groups(rows) if d is not None} - {None})


def test_chain_star_and_shared_passage(spark, monkeypatch):
    """Near copies that only a third document connects, and passages in unlike documents, with
    tiles cut into several blocks."""
    monkeypatch.setattr(jaccard_join, "TILE_BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "FAMILY_BLOCK", 3)
    base = words(10, 300).split()
    rows = []
    for k in range(30):  # each differs from the next in a few places, from the first in many
        text = list(base)
        for j in range(k):
            text[(37 * j) % 300] = f"edit{j}"
        rows.append((k, " ".join(text)))
    passage = words(11, 60)
    rows += [(100 + k, words(20 + k, 80) + " " + passage) for k in range(25)]
    rows += [(200 + k, passage + f" tail{k}") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_groups(docs) == near_groups(rows)
    # the same when frequent shingles are treated as such
    monkeypatch.setattr(jaccard_join.frequent_shingles, "__defaults__", (0.001, 5))
    assert len(jaccard_join.frequent_shingles(docs)) > 0
    assert found_groups(docs) == near_groups(rows)


@pytest.mark.parametrize("least", [1, 4, 7, 50_000])
def test_frequent_values_are_found_in_place(least):
    draw = np.random.default_rng(5)
    values = np.concatenate([draw.integers(0, 1 << 63, 40_000), draw.integers(0, 900, 4_000)])
    values = values.astype(np.uint64)
    expected, n = np.unique(values, return_counts=True)
    found, counts = jaccard_join.often(values, least)
    assert found.tolist() == expected[n >= least].tolist()
    assert counts.tolist() == n[n >= least].tolist()


def test_frequent_values_take_little_memory():
    values = np.random.default_rng(6).integers(0, 1 << 63, 1 << 20).astype(np.uint64)
    tracemalloc.start()
    jaccard_join.often(values, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # numpy's own counting takes several times the values
    assert peak < values.nbytes / 2


def test_batches_are_taken_in_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_201))], ["doc_id"])
    slices = list(jaccard_join._slices(iter([batch, batch.slice(0, 0), batch.slice(7, 1)])))
    assert max(x.num_rows for x in slices) <= jaccard_join.SLICE
    assert sum((x.column(0).to_pylist() for x in slices), []) == [*range(1_201), 7]


def test_few_rows_are_sent_at_a_time(spark):
    def sent():
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["rows"])

        return [r.rows for r in spark.range(0, 1_201, 1, 1).mapInArrow(run, "rows long").collect()]

    usual = spark.conf.get(scratch.BATCH_ROWS)
    assert sent() == [1_201]
    with pytest.raises(KeyError), scratch.few_rows(spark):
        assert max(sent()) <= scratch.SLICE and sum(sent()) == 1_201
        raise KeyError
    assert spark.conf.get(scratch.BATCH_ROWS) == usual
    try:
        spark.conf.set(scratch.BATCH_ROWS, 7)
        with scratch.few_rows(spark):
            assert max(sent()) == 7
    finally:
        spark.conf.set(scratch.BATCH_ROWS, usual)


def test_texts_and_sets_go_to_workers_in_few_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(k, words(1, 30)) for k in range(3)], "doc_id long, text string")
    rows = {}

    def noted(df, label):
        rows[label] = int(spark.conf.get(scratch.BATCH_ROWS))
        return scratch.written(df, label)

    monkeypatch.setattr(jaccard_join, "written", noted)
    monkeypatch.setattr(packing, "written", noted)
    monkeypatch.setattr(secret_scan, "written", noted)
    usual = spark.conf.get(scratch.BATCH_ROWS)
    assert jaccard_join.near_groups(docs).count() == 3
    assert secret_scan.redact(docs).count() == 3
    packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    for label in ("near-sets", "near-bounded", "near-links", "redacted", "pack-tokens"):
        assert rows[label] <= scratch.SLICE
    assert spark.conf.get(scratch.BATCH_ROWS) == usual


def test_redaction_and_tokens_hold_few_rows(spark, monkeypatch):
    """What the operators yield for one large batch is no larger than a slice."""
    docs = spark.range(0, 1_201, 1, 1).selectExpr("id AS doc_id", "'password: abcdefgh' AS text")
    parts = []

    class Noted:
        columns, schema, sparkSession = docs.columns, docs.schema, spark

        def mapInArrow(self, run, schema):
            parts.append(run)

        def select(self, *columns):
            return self

    monkeypatch.setattr(secret_scan, "learn_words", lambda docs: "")
    monkeypatch.setattr(secret_scan, "written", lambda df, label: df)
    monkeypatch.setattr(packing, "id_text", lambda docs: docs)
    monkeypatch.setattr(packing, "TaskContext", mock.Mock(**{
        "get.return_value.partitionId.return_value": 0}))
    secret_scan.redact(Noted())
    packing.tokenised(Noted(), public_tokenizers.path("byte_bpe_50k.json"), 2048, 1)
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in docs.collect()])
    for run in parts:
        out = list(run(iter([batch])))
        assert max(b.num_rows for b in out) <= scratch.SLICE
        assert sum((b.column("doc_id").to_pylist() for b in out), []) == [*range(1_201)]


def test_bitmaps_bound_the_overlap():
    draw = np.random.default_rng(0)
    for _ in range(200):
        n = int(draw.integers(5, 200))
        m = int(n * draw.uniform(1, 1.25))
        pool = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
        x, y = np.unique(draw.choice(pool, n)), np.unique(draw.choice(pool, m))
        both = len(np.intersect1d(x, y))
        x, y = sorted((x, y), key=len)
        sizes, one = np.array([len(x), len(y)]), np.array([1])
        bound = jaccard_join.by_bitmaps(sizes, [jaccard_join.bitmap(x), jaccard_join.bitmap(y)])
        assert bound.shared(0, one)[0] >= both
        assert jaccard_join.by_shingles([x, y]).shared(0, one)[0] == both


def test_components(spark):
    draw = np.random.default_rng(1)
    edges = [tuple(map(int, e)) for e in draw.integers(0, 300, (200, 2))] + [
        (k, k + 1) for k in range(400, 480)] + [(500, 500), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
                   .collect()))
    label = {x: x for e in edges for x in e if x is not None}
    for _ in label:
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    assert {k: label[k] for k in got} == got
    assert set(got) == {x for a, b in edges if a is not None and a != b for x in (a, b)}


@pytest.mark.parametrize("docs", ["edge", "small", "empty"])
def test_sharding(request, docs):
    docs = request.getfixturevalue(docs)
    rows = docs.select("doc_id", "text").collect()
    got = sharding.shard_documents(docs, 8).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()))
        for r in rows)
    by_shard = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < 8 and r.law == "bytes" and r.grown_shard is None
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_shards_of_equal_bytes_keep_equal_texts_together(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = sharding.shard_documents(docs).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == 24 and size.max() < 1.02 * size.mean() and size.min() > 0.98 * size.mean()
    assert got.groupby("text_crc32")["shard"].nunique().max() == 1


def test_hot_text_is_cut(spark):
    docs = spark.createDataFrame(
        [(i, "hot text " * 20, "en", "a") for i in range(3000)]
        + [(5000 + i, words(i, 30), "en", "b") for i in range(2000)],
        "doc_id long, text string, lang string, source string")
    size = sharding.shard_documents(docs).toPandas().groupby("shard")["size"].sum()
    assert len(size) == 24 and size.max() < 1.05 * size.mean()


def test_nearest_neighbours(spark):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(1500, 24)).astype(np.float32)
    vectors *= draw.uniform(0.2, 2, (1500, 1)).astype(np.float32)  # lengths differ
    vectors[600:700] = vectors[0]                                   # a hot vector
    rows = [(i, v.tolist(), 1, "clash") for i, v in enumerate(vectors)]
    rows += [(20_000, None, 1, ""), (20_020, [0.0] * 24, 1, ""), (20_040, [float("nan")] * 24, 1,
             ""), (20_060, [1.0, None] + [0.0] * 22, 1, ""), (20_080, [1.0] * 3, 1, ""),
             (None, [1.0] * 24, 1, ""), rows[40], rows[40]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, key string")
    got = defaultdict(list)
    for r in sorted(ann.nearest(table).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    exact = vectors.astype(np.float64)
    recall = []
    assert set(got) == set(range(0, 1500, 20))
    for q, hits in got.items():
        score = exact @ exact[q]
        want = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:20]
        assert [r for r, _, _ in hits] == list(range(1, 21))
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in hits)
        order = [(-s, v) for _, v, s in hits]
        assert order == sorted(order) and q not in [v for _, v, _ in hits]
        recall.append(len({v for _, v, _ in hits} & set(want)) / 20)
    assert np.mean(recall) >= 0.95


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equal_scores_go_to_the_smaller_ids(spark, kind):
    """More vectors tie than a search holds, some of them equal to each other."""
    rows = [(0, [1.0] + [0.0] * 15)]
    for i in range(1, 400):
        rest = np.random.default_rng(i % 300).normal(size=15)
        rows.append((i, [0.17, *rest.tolist()]))
    rows += [(1000, [0.5] + [0.0] * 15), (1001, [0.0] * 14 + [1.0, 0.0])]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(5)
    got = sorted((r["rank"], r.vec_id, r.score) for r in ann.nearest(table).collect()
                 if r.query_id == 0)
    tie = 0.17 if kind == "double" else float(np.float32(0.17))
    assert got == [(1, 1000, 0.5)] + [(n + 1, n, tie) for n in range(1, 20)]


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0])],
                                "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(few).collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert ann.nearest(few.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op5_license_scan", "op8_line_dedup"])
def test_queries_against_sql(spark, name):
    from riskloom.llm.queries import LLM_ORACLE, LLM_QUERIES
    folder = "/root/testdata/sf0.01"
    rows, fault = difference(spark, connect(folder), LLM_QUERIES[name], LLM_ORACLE[name], folder)
    assert fault is None and rows > 0, fault


def test_licences_of_edge_documents(edge, empty):
    rows = {(r.doc_id, r.origin): r for r in license_scan.scan(
        license_scan.documents_as_files(edge)).collect()}
    assert rows[17, "own"].license == "MIT" and rows[25, "own"].license == "Apache-2.0"
    # src1 has the licence file 25; other sources have none
    assert rows[1, "inherited"].license == "Apache-2.0" and rows[2, "none"].license is None
    assert rows[None, "none"].path is None
    assert license_scan.scan(license_scan.documents_as_files(empty)).count() == 0


NOTICES = {
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the "
               "terms of the GNU General Public License as published by the Free Software "
               "Foundation, either version 3 of the License, or (at your option) any later "
               "version.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without "
                    "modification, are permitted provided that the following conditions are met:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
               "2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
               "at https://mozilla.org/MPL/2.0/.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and associated documentation files (the \"Software\"), to deal in the "
           "Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
           "and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions:",
}


def test_wrapped_notices(spark):
    rows, want = [], {}
    for width in (30, 50, 72, 79, 1000):
        for start, stop, before, after in (
                ("", "", "", ""), ("# ", "", "#!/bin/sh\n", "\nset -e"), ("// ", "", "", "\nf();"),
                (" * ", "", "/*\n", "\n */\nint x;"), ("", "", "<!--\n", "\n-->\n<p>x</p>"),
                ("/* ", " */", "", "\nint y;"), (";; ", "\r", "", "")):
            for name, notice in NOTICES.items():
                lines = ["Copyright (c) 2020 Some Body", "", *textwrap.wrap(notice, width), "",
                         "1. Other words follow here"]
                text = before + "\n".join((start + x).rstrip() + stop for x in lines) + after
                want[len(rows)] = (name, "own")
                rows.append((len(rows), f"d{len(rows)}/COPYING", text))
                want[len(rows)] = (name, "inherited")
                rows.append((len(rows), f"d{len(rows) - 1}/a/x.py", "x"))
    other = "all about\nthis licence\nof ours and what the public\nsays of it. No software here"
    want[len(rows)] = (None, "none")
    rows.append((len(rows), "e/COPYING", other))
    got = {r.doc_id: (r.license, r.origin) for r in license_scan.scan(spark.createDataFrame(
        rows, "doc_id long, path string, text string")).collect()}
    assert {k: (v, want[k]) for k, v in got.items() if v != want[k]} == {}
    assert len(got) == len(rows)


def test_nearest_directory_wins(spark):
    mit, gpl = "Released under the MIT License", "SPDX-License-Identifier: GPL-3.0-or-later"
    files = spark.createDataFrame([
        (1, "r/LICENSE", mit), (2, "r/a/COPYING.txt", gpl), (3, "r/a/b/c.py", "x"),
        (4, "r/b/d.py", "x"), (5, "s/e.py", "x"), (6, "r/a/own.py", "# " + mit + "\ncode"),
        (7, "ra/f.py", "x"), (8, "r/b/g.py", "all rights under a licence of another kind")],
        "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.licensed_dir)
           for r in license_scan.scan(files).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("GPL-3.0", "own", None),
                   3: ("GPL-3.0", "inherited", "r/a"), 4: ("MIT", "inherited", "r"),
                   5: (None, "none", None), 6: ("MIT", "own", None), 7: (None, "none", None),
                   8: ("MIT", "inherited", "r")}


def test_licence_of_the_root_reaches_every_relative_path(spark):
    mit = "Released under the MIT License"
    files = spark.createDataFrame(
        [(1, "LICENSE", mit), (2, "main.py", "x"), (3, "src/a.py", "x"), (4, "src/b/c.py", ""),
         (5, None, "x"), (6, "docs/LICENSE", "Licensed under the ISC License"), (7, "docs/a", "x")],
        "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.licensed_dir) for r in license_scan.scan(files).collect()}
    assert got == {1: ("MIT", None), 2: ("MIT", ""), 3: ("MIT", ""), 4: ("MIT", ""),
                   5: (None, None), 6: ("ISC", None), 7: ("ISC", "docs")}


def test_sibling_licences_are_told_apart(spark):
    gnu = ("you can redistribute it and/or modify\n# it under the terms of the GNU {} Public License "
           "as\n# published by the Free Software Foundation, either version {} of the License, or\n"
           "# (at your option) any later version.")
    cases = [
        ("GPL-2.0", "# " + gnu.format("General", "2")), ("GPL-3.0", "# " + gnu.format("General", 3)),
        ("LGPL-2.1", "# " + gnu.format("Lesser General", "2.1")),
        ("LGPL-3.0", "# " + gnu.format("Lesser General", "3")),
        ("AGPL-3.0", "# " + gnu.format("Affero General", "3")),
        ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.0"),
        (None, "This work is licensed under the GNU General Public License, version 1"),
        ("LGPL-2.0", "This work is licensed under the GNU Library General Public License, version 2"),
        ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"), ("CC-BY-4.0", "Licensed under CC BY 4.0"),
        (None, "Licensed under CC BY-SA 3.0"),
        ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons "
                            "Attribution-NonCommercial-ShareAlike 4.0 International License."),
        ("BSD-2-Clause", "// Licensed under the BSD 2-Clause License"),
        ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
        ("Unlicense", "This is free and unencumbered software released into the public domain."),
        ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-only"),
        ("LGPL-3.0", "// SPDX-License-Identifier: LGPL-3.0-or-later"),
        ("ISC", "/* SPDX-License-Identifier: ISC */")]
    files = spark.createDataFrame([(i, f"d{i}/f", t) for i, (_, t) in enumerate(cases)],
                                  "doc_id long, path string, text string")
    got = {r.doc_id: r.license for r in license_scan.scan(files).collect()}
    assert [(got[i], t) for i, (_, t) in enumerate(cases)] == cases


def test_pipeline(spark, marks, edge, empty, tmp_path):
    folder = "/root/testdata/sf0.001"
    pieces = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), docs.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {p.doc_id for p in pieces} == set(texts) and 0 < len(texts) < 200
    # one of each group is left, and no base pattern of a secret
    groups = near_groups(list(texts.items()))
    assert all(d == c for d, _, c in groups)
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (edge, empty):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == rows.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0 or (
            rows is edge)


def test_line_stage_leaves_large_groups_of_copies_whole(spark):
    copy = "\n".join(words(900 + k, 20) for k in range(5))
    rows = [(i, copy, "en", "hot", len(copy)) for i in range(40)]
    for i in range(40, 120):
        text = "subscribe to our letter\n" + words(i, 60)
        rows.append((i, text, "en", "hot", len(text)))
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    name, stage = corpus_pipeline.STAGES[1]
    after = stage(spark, docs, "")
    assert name == "line dedup" and after.columns == docs.columns
    got = {r.doc_id: r.text for r in after.collect()}
    assert got == {i: t if i < 40 else t.split("\n")[1] for i, t, *_ in rows}
    kept = jaccard_join.one_of_each(after).collect()
    assert [r.text for r in kept if r.doc_id < 40] == [copy] and len(kept) == 81


def test_line_stage_leaves_near_copies_whole(spark):
    shared = [words(700 + k, 20) for k in range(11)]
    rows = [(i, "\n".join([*shared, words(i, 20)]), "hot", "mine") for i in range(30)]
    rows += [(i, "subscribe to our letter\n" + words(i, 60), "hot", "mine") for i in range(30, 120)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, source string, n_dropped string").repartition(3)
    after = corpus_pipeline.STAGES[1][1](spark, docs, "")
    assert after.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_dropped) for r in after.collect()}
    assert got == {i: (t if i < 30 else t.split("\n")[1], m) for i, t, _, m in rows}
    kept = [r.text for r in jaccard_join.one_of_each(after).collect() if r.doc_id < 30]
    assert kept == [rows[0][1]]


def test_without_the_subpackage_the_rest_still_imports():
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path, target=None):\n"
            "        if name.startswith('riskloom.llm') or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert 'pipeline' not in e.queries() and len(e.queries()) > 80\n")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
