"""Licences against SQL, neighbours against brute force, and the pipeline stage by stage."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from curveloom.llm import ann, common, decontam, licences, quality, queries, secrets
from curveloom.llm.common import read

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (100, 100), (200, 201), (201, 200)]
    found = dict(tuple(r) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(41)}, 100: 90, 95: 90, 90: 90, 200: 200, 201: 200}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_licences_equal_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    expected = con.execute(queries.SQL["op7_licences"]).fetchall()
    found = queries.op7_licences(spark, folder)
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in found.collect())


def test_licences_run_no_python(spark):
    assert "Python" not in queries.op7_licences(spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_licences_come_from_the_nearest_directory(spark):
    rows = [("LICENSE", "Released under the MIT License."), ("a/b/COPYING", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
            ("a/b/c/d.py", "code"), ("a/x.py", None), ("a/b/own.py", "# Licensed under the Apache License, Version 2.0."),
            ("a/b/own.py", "# Licensed under the Apache License, Version 2.0."), ("ab/y.py", ""), (None, "text")]
    frame = spark.createDataFrame([(p, t, "mine", "k") for p, t in rows], "path string, text string, licence string, _key string")
    found = licences.licences(frame, F.col("path"), F.col("text"))
    assert found.columns == [*frame.columns, "_licence", "similarity", "licence_from"]
    by = {r["path"]: (r["_licence"], r["licence_from"]) for r in found.collect()}
    assert by["LICENSE"] == ("MIT", "LICENSE") and by["a/x.py"] == ("MIT", "LICENSE") and by["ab/y.py"] == ("MIT", "LICENSE")
    assert by["a/b/c/d.py"] == ("GPL-3.0", "a/b/COPYING") and by["a/b/own.py"] == ("Apache-2.0", "a/b/own.py")
    assert found.count() == len(rows) and licences.licences(frame.limit(0), F.col("path"), F.col("text")).count() == 0


WRAPPED = """x = 1
# This Source Code Form is subject to
# the terms of the Mozilla
# Public License, v. 2.0.
y = 2"""


def test_a_wrapped_notice_is_found_at_any_table_size(spark):
    """Weights are those of the table's own lines, so ten thousand others of their kind don't push a notice under."""
    notices = [("a.py", WRAPPED), ("b.py", "Copyright 2024 Acme Inc. All rights reserved."), ("c.py", "This project is released under the MIT License.")]
    for others in (40, 4000):
        files = [(f"f{i}.py", f"This project is project number {i}, released in 2024 by Acme Inc.\n\nCopyright notices are of this source file")
                 for i in range(others)]
        frame = spark.createDataFrame(notices + files, "path string, text string")
        found = {r["path"]: r["licence"] for r in licences.licences(frame, F.col("path"), F.col("text")).collect()}
        assert (found["a.py"], found["b.py"], found["c.py"]) == ("MPL-2.0", "proprietary", "MIT") and found["f1.py"] is None


def test_licences_of_odd_texts(spark):
    """Very long texts, ties of similarity (the first licence by name), missing texts and repeated files."""
    long = "\n".join(f"w{i} w{i + 1}" for i in range(20_000)) + "\n" + "z" * 100_000 + "\nReleased under the MIT License."
    tie = "Licensed under CC BY-SA 4.0.\nReleased under the MIT License."
    rows = [("p/long", long), ("q/tie", tie), ("q/tie", tie), ("r/none", None), (None, ""), ("s/blank", " \n\t\n")]
    found = [(r["path"], r["licence"], r["similarity"]) for r in licences.licences(
        spark.createDataFrame(rows, "path string, text string"), F.col("path"), F.col("text")).collect()]
    assert sorted(found, key=repr) == sorted([("p/long", "MIT", 1.0), *[("q/tie", "CC-BY-SA-4.0", 1.0)] * 2, ("r/none", None, None), (None, None, None),
                                              ("s/blank", None, None)], key=repr)


def exact(rows, queries_, k=5):
    """Brute-force neighbours, ties to the smaller id."""
    out = {}
    for q, v in queries_:
        scored = sorted((-float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), i) for i, w in rows if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def test_neighbour_recall(spark):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in read(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    expected = exact(rows, [r for r in rows if r[0] % 50 == 0])
    found: dict = {}
    for r in queries.op9_neighbours(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(found) == set(expected) and all(len(v) == 5 for v in found.values())
    assert sum(len(set(found[q]) & set(v)) for q, v in expected.items()) >= 0.9 * 5 * len(expected)


def test_neighbours_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (100, None), (9, [1e200, 1e200]), (50, [0.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    found = [tuple(r) for r in ann.search(frame).orderBy("query_id", "rank", "vec_id").collect()]
    assert [(q, n, v) for q, n, v, _ in found if q == 0] == [(0, 1, 1), (0, 2, 2), (0, 3, 9), (0, 4, 50), (0, 5, 50)]
    assert {q for q, *_ in found} == {0, 50} and found[0][3] == 1.0
    assert ann.search(frame.limit(0)).count() == 0


def test_vectors_are_compared_with_all_of_their_length(spark):
    """Lengths other than most rows' have partitions of their own; a query of a length that no other row has finds nothing."""
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8 if i % 10 else 3).tolist()) for i in range(1, 600)] + [(1000, [1.0] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found: dict = {}
    for r in ann.search(frame).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    short = [(i, np.array(v)) for i, v in rows if len(v) == 3]
    assert found == exact(short, [r for r in short if r[0] % 50 == 0])


@pytest.fixture(scope="module")
def clustered():
    """6,000 vectors around 60 centres, which differ much more than a centre's vectors do."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((60, 32))
    return [(i, centres[i % 60] + 0.35 * rng.standard_normal(32)) for i in range(6000)]


def compared(partitions, x, asked):
    """The share of rows that a query is compared with, and how many partitions a row lies in."""
    homes = partitions.homes(x)
    return (partitions.probed(asked) @ homes.sum(axis=0)).mean() / len(x), homes.sum() / len(x)


def test_few_rows_are_compared_where_there_are_clusters(spark, clustered):
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in clustered], "vec_id long, embedding array<double>")
    x = ann._unit([v for _, v in clustered])
    partitions = ann.fit(ann.usable(frame), length=32)
    assert partitions.parts == 32 and compared(partitions, x, x[::50])[0] < 0.5
    expected, found = exact(clustered, clustered[::50]), {}
    for r in ann.nearest(ann.usable(frame), ann.usable(frame.where("vec_id % 50 = 0")), partitions).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert sum(len(set(found[q]) & set(v)) for q, v in expected.items()) >= 0.9 * 5 * len(expected)


def test_partitions_grow_with_the_table(spark, clustered):
    rows = ann.usable(spark.createDataFrame([(i, v.tolist()) for i, v in clustered], "vec_id long, embedding array<double>"))
    assert [ann.fit(rows, part_rows=n, most_parts=64, length=32).parts for n in (512, 100, 10)] == [32, 64, 64]


def test_border_vectors_are_found_once(spark, clustered):
    """A wide border lays every vector into two partitions; asked of all, each row is found once, as by brute force."""
    some = clustered[:600] + [(9000 + i, clustered[0][1]) for i in range(3)]
    rows = ann.usable(spark.createDataFrame([(i, v.tolist()) for i, v in some], "vec_id long, embedding array<double>"))
    x = ann._unit([v for _, v in some])
    partitions = ann.replace(ann.learned(np.unique(x, axis=0), 8), border=1e9, around=None)
    assert compared(partitions, x, x[:1]) == (2.0, 2.0)
    found: dict = {}
    for r in ann.nearest(rows, rows.where("vec_id % 50 = 0"), partitions).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == exact(some, [r for r in some if r[0] % 50 == 0])


def test_a_partition_of_one_repeated_vector_is_split(spark):
    rng = np.random.default_rng(0)
    rows = [(i, ([1.0] * 8 if i % 3 else rng.standard_normal(8).tolist())) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    usable = ann.usable(frame)
    asked = usable.where("vec_id % 50 = 0")
    expected = exact([(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in rows if i % 50 == 0])
    found: dict = {}
    for r in ann.nearest(usable, asked, ann.Partitions(1), block_rows=40, block_queries=4).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == expected


def test_pipeline_against_its_stages(spark):
    docs = read(spark, SMALL, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SMALL), name)
        steps[name] = docs
    columns = read(spark, SMALL, "documents").columns
    assert all(d.columns == columns for n, d in steps.items() if n != "best_fit_packing")
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in steps.items()}
    good = {r["doc_id"] for r in quality.scored(read(spark, SMALL, "documents")).where("NOT rejected").collect()}
    assert ids["quality_classifier"] == good
    import brute

    component = {d: c for d, _, c in brute.near_duplicates([(d, rows[d]) for d in sorted(good)])}
    assert ids["simhash_near_dedup"] == set(component.values())
    items = [decontam.normalised(r["text"]) for r in read(spark, SMALL, "benchmark").collect()]
    clean = {d for d in ids["simhash_near_dedup"] if not any(i in decontam.normalised(rows[d]) for i in items if len(i) >= 16)}
    assert ids["benchmark_decontamination"] == clean == ids["secret_scan"] == ids["best_fit_packing"]
    for r in steps["secret_scan"].collect():
        found = secrets.scan_batch([rows[r["doc_id"]]], secrets.default_rules())[0]
        assert (r["text"] == rows[r["doc_id"]]) == (not found) and r["n_chars"] == len(r["text"])
    assert corpus_pipeline.run(spark, SMALL).count() == steps["best_fit_packing"].count()


def test_pipeline_on_odd_and_no_rows(spark, odd, nothing):
    for table in (odd, nothing):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = common.written(stage(spark, docs, SMALL), name)
            assert name == "best_fit_packing" or docs.columns == table.columns
        if table is nothing:
            assert docs.count() == 0
