"""Whitening, filter audit and MinHash against brute force, on the table and on odd rows."""

import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from headway.llm import audit, minhash, whitening

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(300)]


@pytest.fixture(scope="module")
def odd_docs(spark, tmp_path_factory):
    """Nulls, empty, white, short, long, repeated rows, capitals, symbols, near copies, clashing columns."""
    r = random.Random(7)
    base = " ".join(r.choice(WORDS) for _ in range(200))
    near = base.replace(base.split()[100], "changed", 1)
    long = " ".join(r.choice(WORDS) for _ in range(30_000))
    rows = [
        (1, base, "en"),
        (2, base, "en"),
        (3, near, "de"),
        (4, None, None),
        (5, "", "en"),
        (6, " \t\n ", "en"),
        (7, "ONE two", "en"),
        (8, "one TWO", "en"),
        (9, long, "fr"),
        (9, long, "fr"),
        (10, "A#B " * 60, "en"),
        (11, "Ärger " + base, "en"),
        (None, base, "en"),
        (12, base.upper(), "en"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("_doc", "_key", "part", "mask", "x", "y", "star", "band", "bucket", "hashes", "sig", "rep", "u", "v"):
        df = df.withColumn(name, F.lit("x"))
    path = str(tmp_path_factory.mktemp("odd3") / "documents.parquet")
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def odd_labels(spark):
    rows = [(1, 1, 0), (1, 0, 1), (3, 1, 0), (9, 1, 1), (None, 1, 1), (12, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# --- op11 ------------------------------------------------------------------------------------


def _brute_whitening(vectors):
    X = np.floor(np.asarray(vectors, dtype=np.float64) * 64).astype(np.int64) + 1_000_000
    n = len(X)
    S = X.sum(0)
    V = np.cov(X.T.astype(float), bias=True)
    e, U = np.linalg.eigh(V)
    o = np.argsort(e)[::-1]
    return X, S, e[o], U[:, o]


def test_whitening_against_numpy(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = whitening.digest(emb).toPandas()
    tab = emb.toPandas().sort_values("vec_id")
    X, S, e, U = _brute_whitening(list(tab.embedding))
    n = len(X)
    k = min(32, X.shape[1])
    want = (X - S / n) @ U[:, :k] / np.sqrt(e[:k])
    m = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().values
    sign = np.sign((m * want).sum(0))
    assert np.abs(m * sign - want).max() < 1e-6
    dev = ((n * X - S).astype(object) ** 2).sum(1)
    assert list(got.groupby("vec_id").deviation.first().sort_index()) == list(dev)
    assert np.allclose(got.groupby("component").explained.first().values, e[:k] / e.sum(), rtol=1e-4)
    assert got.identity_error.max() <= 1e-4 and (got.n == n).all()


def test_whitening_odd_rows(spark):
    rows = [
        (1, [0.5, -0.25, 0.0]),
        (2, [0.1, 0.2, 0.3]),
        (2, [0.1, 0.2, 0.3]),
        (3, None),
        (4, [0.1, None, 0.2]),
        (5, [float("nan"), 0.0, 0.0]),
        (6, [float("inf"), 0.0, 0.0]),
        (7, [0.9, 0.9, -0.9]),
        (8, [0.3]),
        (None, [0.0, 0.0, 0.0]),
        (9, [-0.7, 0.4, 0.05]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash"))
    got = whitening.digest(df).toPandas()
    assert set(got.vec_id) == {1, 2, 7, 9}
    assert (got.n == 5).all() and got.component.max() <= 3
    assert got.identity_error.max() <= 1e-4
    assert whitening.digest(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, [0.1, 0.2])], "vec_id long, embedding array<float>")
    assert whitening.digest(one).count() == 0  # no spread: nothing to whiten


# --- op12 ------------------------------------------------------------------------------------


def _audit_sql(docs_pdf, labels_pdf):
    con = duckdb.connect()
    con.register("documents", docs_pdf)
    con.register("labels", labels_pdf)
    return con.sql(audit.ORACLE_SQL).df()


def _same(a, b):
    k = ["part", "filter_order", "step"]
    cols = k + ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    a = a[cols].sort_values(k).reset_index(drop=True).astype(str)
    b = b[cols].sort_values(k).reset_index(drop=True).astype(str)
    pd.testing.assert_frame_equal(a, b)


def test_audit_against_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    _same(audit.digest(docs, labels).toPandas(), _audit_sql(docs.toPandas(), labels.toPandas()))


def test_audit_odd_rows(spark, odd_docs, odd_labels):
    got = audit.digest(odd_docs, odd_labels).toPandas()
    _same(got, _audit_sql(odd_docs.select("doc_id", "text", "lang").toPandas(), odd_labels.toPandas()))
    assert len(got) == 600 * 4  # parts en, de, fr and '' (null lang)
    assert audit.digest(odd_docs.limit(0), odd_labels).count() == 0


def test_byte_pass_counts():
    import pyarrow as pa

    texts = ["", None, " a  bb\tA\n", "ÄÖ x|y", "a a a", "é" * 3 + " " + "é" * 3]
    c = audit.scan(pa.array(texts))
    assert list(c["words"]) == [0, 0, 3, 2, 3, 2]
    assert list(c["distinct"]) == [0, 0, 3, 2, 1, 1]
    assert list(c["capitals"]) == [0, 0, 1, 0, 0, 0]
    assert list(c["code_points"]) == [0, 0, 9, 6, 5, 7]
    assert list(c["symbols"]) == [0, 0, 0, 1, 0, 0]


# --- op13 ------------------------------------------------------------------------------------


def _sets(text):
    t = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
    if len(w) < 3:
        return frozenset([" ".join(w)]) if w else frozenset()
    return frozenset(" ".join(w[i : i + 3]) for i in range(len(w) - 2))


def _brute_components(rows):
    sets = {}
    for d, t in rows:
        if d is not None:
            sets.setdefault(d, set()).add(_sets(t))
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    items = [(d, s) for d, ss in sets.items() for s in ss if s]
    for i, (x, a) in enumerate(items):
        for y, b in items[i + 1 :]:
            inter = len(a & b)
            if 100 * inter >= 85 * (len(a) + len(b) - inter):
                rx, ry = root(x), root(y)
                if rx != ry:
                    parent[max(rx, ry)] = min(rx, ry)
    return {d: min(k for k in sets if root(k) == root(d)) for d in sets}


@pytest.mark.parametrize("which", ["table", "odd"])
def test_minhash_against_brute_force(spark, odd_docs, which):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if which == "table" else odd_docs
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = _brute_components(rows)
    got = minhash.digest(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id], r.doc_id
            assert r.kept == (r.doc_id == r.component_id)
    sizes = {r.doc_id: r.n_shingles for r in got}
    for d, t in rows:
        if d is not None and d != 9:
            assert sizes[d] == len(_sets(t))
    if which == "odd":
        comp = {r.doc_id: r.component_id for r in got}
        assert comp[2] == 1 and comp[3] == 1 and comp[12] == 1 and comp[7] == 7 and comp[8] == 7
        assert comp[4] == 4 and comp[5] == 5 and sizes[4] == 0


def test_minhash_empty(spark, odd_docs):
    assert minhash.digest(odd_docs.limit(0)).count() == 0


def test_bayesian_looks_keep_threshold_pairs():
    # A pair right at the threshold keeps almost all of its equal positions: never pruned.
    for looked, fewest in minhash.LOOKS:
        assert fewest <= 0.85 * looked - 3
    assert minhash.LOOKS[0][1] > 0  # the first look does prune dissimilar pairs


# --- pipeline stages: rows numbered once -----------------------------------------------------


@pytest.mark.parametrize("stage_name", ["quality", "near_duplicates", "repeated_passages", "decontaminated"])
def test_stage_rows_do_not_depend_on_splits(spark, stage_name):
    """A filtering stage keeps the same rows however its input is split, and keeps a ``_row`` column."""
    import corpus_pipeline

    step = dict(corpus_pipeline.STAGES)[stage_name]
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns(
        {"_row": F.lit("mine"), "row": F.col("doc_id") * 2}
    )
    results = []
    for parallelism, split in (("2", "128MB"), ("16", "64KB")):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", parallelism)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            got = step(spark, docs, SF)
            results.append(sorted((r.doc_id, r._row, r.row, r.text) for r in got.collect()))
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert results[0] == results[1]
    assert results[0] and all(r[1] == "mine" and r[2] == 2 * r[0] for r in results[0])


def test_minhash_signatures_in_slices():
    """The sliced NumPy pass equals the plain definition; empty and null sets have none."""
    import pyarrow as pa

    r = random.Random(3)
    rows = [[r.randrange(-(2**63), 2**63) for _ in range(r.randrange(0, 9))] if r.random() > 0.1 else None for _ in range(300)]
    old, minhash.SLICE_VALUES = minhash.SLICE_VALUES, 7
    try:
        got = minhash.signatures(pa.array(rows, pa.list_(pa.int64()))).to_pylist()
    finally:
        minhash.SLICE_VALUES = old
    for x, s in zip(rows, got):
        if not x:
            assert s is None
            continue
        v = np.array(x, dtype=np.int64).view(np.uint64)
        with np.errstate(over="ignore"):
            want = (v[:, None] * minhash.A[None, :] + minhash.B[None, :]).min(0).view(np.int64)
        assert s == list(want)
