"""Whitening, codes of vectors and common lines against brute force; edge cases of each."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.llm import codes, linededup, queries, whitening
from gridweave.llm.common import table

VECTORS = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def given(small, spark):
    return [(r.vec_id, list(r.embedding), r.label) for r in table(spark, small, "embeddings").collect()]


def whole(c):
    return math.floor(1024 * float(np.float32(c)))


def odd(spark, width=6, n=60):
    """Rows with nulls, gaps, other lengths, repeats, null ids and labels, and columns whose names are used inside."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, width)], i % 3) for i in range(n)]
    rows += [(7, rows[7][1], 1)] * 3 + [(None, rows[9][1], None), (200, rows[4][1], None)]
    bad = [(100, None, 1), (101, [None] * width, 1), (102, [NAN] + [0.0] * (width - 1), 2), (103, [INF] + [0.0] * (width - 1), 2), (104, [], 1), (105, [1.0], 1), (None, None, None)]
    df = spark.createDataFrame(rows + bad, VECTORS)
    for name in ("n", "code", "error", "component", "id", "vector", "rows", "block", "part", "of", "ids", "trees"):
        df = df.withColumn(name, F.lit("x"))
    return df, rows


# whitening


def plainly_whitened(rows, most=8):
    x = np.array([[whole(c) + 100_000 for c in v] for _, v, _ in rows], object)
    n, total = len(rows), x.sum(0)
    deviation = ((n * x - total) ** 2).sum(1)
    centred = x.astype(float) - np.array([s / n for s in total])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return deviation, centred @ u / np.sqrt(np.where(e > 0, e, np.nan)), e / np.trace(v)


def same_up_to_sign(got, want):
    return all(min(np.abs(got[:, k] - s * want[:, k]).max() for s in (1, -1)) < 1e-8 for k in range(want.shape[1]))


@pytest.mark.parametrize("tile, rows", [(16, 4096), (5, 37)])
def test_whitening_equals_plain_algebra(spark, small, monkeypatch, tile, rows):
    monkeypatch.setattr(whitening, "TILE", tile)  # closures are sent by value
    monkeypatch.setattr(whitening, "ROWS", rows)
    source = given(small, spark)
    deviation, want, explained = plainly_whitened(source)
    got = queries.op11_whitening(spark, small).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 8 * len(source) and (got.n == len(source)).all()
    order = np.argsort([i for i, _, _ in source])
    assert got.deviation.to_numpy().reshape(-1, 8)[:, 0].tolist() == deviation[order].tolist()
    assert same_up_to_sign(got.whitened.to_numpy().reshape(-1, 8), want[order])
    assert np.allclose(got.explained.to_numpy()[:8], explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error.iloc[0] < 1e-9


def test_whitening_of_odd_rows(spark):
    df, rows = odd(spark)
    got = whitening.whiten(df).toPandas()
    assert len(got) == 6 * len(rows) and (got.n == len(rows)).all() and got.vec_id.isna().sum() == 6
    deviation, want, _ = plainly_whitened(rows, 6)
    assert sorted(got[got.component == 1].deviation) == sorted(deviation)
    mine = got[got.vec_id == 11].sort_values("component").whitened.to_numpy()
    assert np.allclose(np.abs(mine), np.abs(want[11]))
    assert whitening.whiten(df.where("vec_id = 100")).count() == 0 and whitening.whiten(df.limit(0)).count() == 0


def test_whitening_without_variance_and_with_great_numbers(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5], 0)] * 4, VECTORS)).toPandas()
    assert len(one) == 8 and one.whitened.isna().all() and one.explained.isna().all() and one.identity_error.isna().all() and (one.deviation == 0).all()
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], 0) for i in range(5)], VECTORS)).toPandas()
    assert flat[flat.component == 1].whitened.notna().all() and flat[flat.component == 2].whitened.isna().all()
    great = whitening.whiten(spark.createDataFrame([(1, [3e38, 1.0], 0), (2, [-3e38, 1.0], 0), (3, [0.0, 2.0], 0)], VECTORS)).toPandas()
    assert great.deviation.isna().sum() == 4 and great[great.vec_id == 3].deviation.nunique() == 1
    x = np.array([[2**31, 5]])
    assert whitening.deviations(x, 3, [2**31, 5]) == [4 * 2**62 + 100 if 4 * 2**62 + 100 < 2**63 else None]
    assert whitening.deviations(np.array([[2**30, 5]]), 2, [2**30, 5]) == [2**60 + 25]


# codes


def plainly_coded(rows, parts=4, entries=256, rounds=4):
    kept = sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    width = len(kept[0][1])
    d = -(-width // parts)
    x = np.array([[whole(c) for c in v] + [0] * (parts * d - width) for _, v, _ in kept]).reshape(len(kept), parts, d)
    books = [x[:entries, p].copy() for p in range(parts)]
    chosen = np.zeros((len(kept), parts), int)
    for step in range(rounds + 1):
        for p in range(parts):
            distance = ((x[:, p, None, :] - books[p][None]) ** 2).sum(2)
            chosen[:, p] = distance.argmin(1)
            if step < rounds:
                for k in range(len(books[p])):
                    mine = x[chosen[:, p] == k, p]
                    if len(mine):
                        books[p][k] = mine.sum(0) // len(mine)
    error = sum(((x[:, p] - books[p][chosen[:, p]]) ** 2).sum(1) for p in range(parts))
    total = Counter()
    for (_, _, label), e in zip(kept, error, strict=True):
        total[label] += int(e)
    sha = hashlib.sha256(",".join(str(c) for b in books for z in b for c in z).encode()).hexdigest()
    return sorted((i is None, i or 0, "".join(f"{c:02x}" for c in row), int(e), total[label], sha) for (i, _, label), row, e in zip(kept, chosen, error, strict=True))


def rows_of(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_codes_equal_plain_rounds(spark, small, monkeypatch):
    assert rows_of(queries.op12_codes(spark, small)) == plainly_coded(given(small, spark))


@pytest.mark.parametrize("entries, rows", [(256, 8192), (9, 11)])
def test_codes_of_odd_rows(spark, monkeypatch, entries, rows):
    monkeypatch.setattr(codes, "ROWS", rows)
    df, kept = odd(spark)
    assert rows_of(codes.digests(*codes.compress(df, entries=entries))) == plainly_coded(kept, entries=entries)


def test_codes_of_empty_tables(spark):
    df, _ = odd(spark)
    for none in (df.limit(0), df.where("vec_id in (100, 102, 104)")):
        rows, books = codes.compress(none)
        assert codes.digests(rows, books).count() == 0


@pytest.mark.parametrize("spread, d", [(2, 2), (600, 16), (3, 16)])
def test_trees_assign_as_all_distances_do(spread, d):
    rng = np.random.default_rng(spread + d)
    points = rng.integers(-spread, spread + 1, (700, d))
    points[100:400] = points[3]  # copies share subtrees
    entries = np.concatenate([points[:40], points[:5]])  # equal entries: the lower index
    tree = codes.Tree.built(points)
    chosen, counts, sums, at_once = tree.nearest(entries.astype(np.int64))
    want = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
    assert (chosen == want[tree.order]).all() and (counts == np.bincount(want, minlength=45)).all()
    assert (sums == [points[want == k].sum(0) for k in range(45)]).all() and at_once >= 150


def test_great_components_stay_exact():
    d = 16
    cells = np.array([[3e38] * d, [-3e38] * d, [0.0] * d])
    x = codes.parts_of(cells, 1, d)[:, 0]
    tree = codes.Tree.built(x)
    assert codes.Tree.built(x).nearest(x[:2])[0].tolist() == [[0, 1, 0][i] for i in tree.order]


def test_decoded_vectors_are_the_entries(spark, small):
    rows, books = codes.compress(table(spark, small, "embeddings"))
    back = codes.decoded(rows, books).where("id < 20").collect()
    source = {i: v for i, v, _ in given(small, spark)}
    for r in back:
        x = np.array([whole(c) for c in source[r.id]])
        assert ((x - np.array(r.vector) * 1024) ** 2).sum() == r.error


# lines

LINES = "doc_id long, text string, lang string, source string, n_chars long"


def plain_lines(rows, documents=10, least=1):
    """(id, text) -> (lines, dropped, kept text)."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip("\t\n\x0b\x0c\r ").translate(low)
    found = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                found.setdefault(key(line), set()).add(i if i is not None else ("text", text))
    common = {k for k, v in found.items() if len(v) >= documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in common]
        out.append((i is None, i or 0, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def digested(df):
    kept = df.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("sha")).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.sha) for r in kept)


def test_common_lines_equal_plain_python(spark, small):
    source = [(r.doc_id, r.text) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    got = sorted((r.doc_id is None, r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op13_linededup(spark, small).collect())
    assert got == plain_lines(source)


ODD = [(1, None), (2, ""), (3, "\n"), (4, "  \n\t\n"), (5, "Hot Line\n"), (None, "no id\nhot line"), (None, "other\nhot line"), (None, "other\nhot line"), (7, "É\né\nfoo"), (7, "É\né\nfoo"), (8, "x" * 300_000 + "\nhot line"), (9, "\n".join(["hot line"] * 5000)), (10, " hot line"), (10, "hot\x0bline"), (10, "hot line\r\n\x0c HOT LINE \x0b\nend")]


@pytest.mark.parametrize("bound, documents, least", [(1_000_000, 4, 1), (-1, 4, 1), (-1, 1, 4), (1_000_000, 10, 1)])
def test_common_lines_of_odd_rows(spark, monkeypatch, bound, documents, least):
    monkeypatch.setattr(linededup, "BOUND", bound)  # below 0: joins by shuffle
    rows = ODD + [(20 + i, f"hot line\nonly {i}\nÉa") for i in range(4)]
    df = spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], LINES)
    for name in ("places", "hash", "doc", "id", "place", "n_lines", "batch", "key", "line"):
        df = df.withColumn(name, F.lit("x"))
    got = linededup.without_common_lines(df, documents=documents, least=least)
    assert digested(got) == plain_lines(rows, documents, least)
    assert set(df.columns) | {"n_dropped"} == set(got.columns) and got.where("hash <> 'x'").count() == 0
    assert linededup.without_common_lines(df.limit(0)).count() == 0


def test_runs_are_levelled_and_batches_add_up(spark):
    index = linededup.LineIndex(spark, documents=3, fanout=2)
    hashes = lambda values, doc: spark.createDataFrame([(bytes([v]), doc) for v in values], "hash binary, doc long")
    for doc in range(5):
        index.add(hashes([1, 1, 2, 10 + doc], doc))
    assert [len(level) for level in index.levels] == [1, 0, 1]
    assert {bytes(r.hash)[0] for r in index.common().collect()} == {1, 2}
    index.add(hashes([1, 10], 9).unionByName(hashes([10], 8)))
    assert {bytes(r.hash)[0] for r in index.common().collect()} == {1, 2, 10}
    last = index.runs()[-1]  # what had reached the threshold in a run was not added again
    assert {bytes(r.hash)[0]: r.n for r in last.where(F.col("hash").isin(bytes([1]), bytes([10]))).collect()} == {bytes([10])[0]: 2} or last.count() > 2
    plan = index.runs()[0].join(index.runs()[-1].hint("merge"), "hash", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    index.clear()
