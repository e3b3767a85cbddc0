"""Embedding deduplication, nearest neighbours, URL rules and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from compare import bag, connect
from gridyield.llm import embedding_dedup
from gridyield.llm.components import connected
from gridyield.llm.embedding_dedup import fit_grid, linked_vectors
from gridyield.llm.nearest import chi_square_quantile, leaves, nearest_neighbours
from gridyield.llm.queries_url import BASE_RULES, MORE_RULES
from gridyield.llm.url_filter import match_urls, rules_table
from gridyield.llm.vectors import matrix, usual_length

SCHEMA = "vec_id bigint, embedding array<float>, label int, id bigint, v string, cell string, n int"
ODD = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0), (903, [float("inf")] + [1.0] * 15, 0), (904, [None] + [1.0] * 15, 0), (905, [1.0, 2.0], 0), (906, [1.0] * 16, None), (None, [1.0] * 16, 0), (907, [], 1)]


def vectors(seed: int, n: int = 400):
    """Random vectors in three labels with near copies, scaled copies and exact copies among them."""
    draw = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        if k and draw.random() < 0.4:
            base = np.array(rows[draw.integers(0, len(rows))][1])
            v = base * draw.choice([1.0, 3.0]) + draw.normal(0, 1, 16) * draw.choice([0.0, 0.05, 0.15])
        else:
            v = draw.normal(0, 1, 16)
        rows.append((k, v.astype(np.float32).tolist(), int(draw.integers(0, 3))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "v", "c", 1) for r in rows], SCHEMA)


def brute_links(rows, cosine):
    good = [(i, np.array(v, float), g) for i, v, g in rows if i is not None and g is not None and v and len(v) == 16 and None not in v]
    good = [(i, v / np.linalg.norm(v), g) for i, v, g in good if np.isfinite(v).all() and v.any()]
    root, count = {i: i for i, *_ in rows if i is not None}, dict.fromkeys((i for i, *_ in rows if i is not None), 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, u, g) in enumerate(good):
        for b, w, h in good[k + 1:]:
            if g == h and a != b and u @ w >= cosine:
                count[a] += 1
                count[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (count[i], find(i), find(i) == i) for i in root}


@pytest.mark.parametrize("block", [2048, 7])
def test_links_equal_brute_force_with_full_recall(spark, block):
    rows = vectors(block) + ODD
    got = linked_vectors(frame(spark, rows), recall=1.0, block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == brute_links(rows, 0.98)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, False)]


def test_recall_of_the_stop(spark):
    rows = vectors(11, 600)
    exact = brute_links(rows, 0.98)
    got = {r.vec_id: r.n_links for r in linked_vectors(frame(spark, rows), recall=0.99).collect()}
    assert sum(got.values()) >= 0.97 * sum(v[0] for v in exact.values()) and all(got[i] <= v[0] for i, v in exact.items())


def test_repeated_rows_and_empty_tables(spark):
    rows = vectors(1, 30)
    got = linked_vectors(frame(spark, rows + rows[:3]), recall=1.0).collect()
    assert len(got) == 33 and {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_links(rows, 0.98)
    assert linked_vectors(frame(spark, [])).collect() == []
    only = linked_vectors(frame(spark, [(1, None, 0)])).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in only] == [(1, 0, 1, True)]
    one = linked_vectors(frame(spark, [(1, [1.0] * 16, 0), (2, [2.0] * 16, 0)])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in one) == [(1, 1, 1), (2, 1, 1)]


def test_traversal_is_in_order_and_complete(spark):
    grid = fit_grid(frame(spark, vectors(3, 300)), "embedding", 0.98, 1.0)
    unit = np.array([r[1] for r in vectors(3, 20)])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    _, _, h1, h2 = grid.plane_distances(unit)
    for p, q in zip(h1, h2):
        i, j = grid.visited(p, q)
        cost = p[i] + q[j]
        assert (np.diff(cost) >= 0).all() and len(i) == (p[:, None] + q[None, :] <= grid.stop).sum()


@pytest.mark.parametrize(("cell", "block", "asked"), [(8192, 16384, 512), (60, 16384, 3), (60, 20, 512)])
def test_neighbours_equal_brute_force(spark, cell, block, asked):
    rows = vectors(cell + block) + ODD + [(4000, vectors(cell + block)[0][1], 0)]
    got: dict = {}
    for r in nearest_neighbours(frame(spark, rows), every=50, k=10, confidence=1 - 1e-9, cell=cell, block=block, asked=asked).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    assert set(got) == {i for i, _ in good if i % 50 == 0}
    for i, v in good:
        if i % 50 == 0:
            best = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in good if j != i)[:10]
            assert [(k + 1, j, d) for k, (d, j) in enumerate(best)] == sorted(got[i])


def test_few_or_no_candidates(spark):
    assert nearest_neighbours(frame(spark, [])).collect() == []
    assert nearest_neighbours(frame(spark, [(100, [1.0] * 16, 0)])).collect() == []
    got = nearest_neighbours(frame(spark, [(100, [1.0] * 16, 0), (1, [2.0] * 16, 0), (100, [1.0] * 16, 0), (3, [2.0] * 16, 0)])).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(100, 1, 1, 4.0), (100, 2, 3, 4.0)]


def test_quantile_and_leaves():
    assert abs(chi_square_quantile(0.95, 8) - 15.507) < 1e-3 and abs(chi_square_quantile(0.5, 2) - 1.3863) < 1e-3
    points = np.random.default_rng(1).normal(0, 1, (1000, 3))
    assert sorted(np.concatenate(leaves(points, 50)).tolist()) == list(range(1000)) and max(map(len, leaves(np.zeros((100, 2)), 8))) <= 8


def test_matrix_leaves_out_what_is_no_vector():
    rows, values = matrix(pa.array([[1.0, 2.0], None, [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [1.0], [3.0, 4.0]], pa.list_(pa.float64())))
    assert rows.tolist() == [0, 6] and values.tolist() == [[1.0, 2.0], [3.0, 4.0]]


LONGER = [[(910, [1.0] * 20, 0)], [(911, [float("nan")] + [1.0] * 23, 0)], [(912, [1.0] * 20, 0), (950, [2.0] * 24, 1), (914, [float("nan")] * 30, 0), (915, [0.0] * 31, 0)]]


@pytest.mark.parametrize("longer", LONGER)
def test_longer_vectors_are_left_out(spark, longer):
    rows = vectors(21, 120) + ODD + longer
    got = linked_vectors(frame(spark, rows), recall=1.0).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == brute_links(rows, 0.98)
    near = [sorted(map(tuple, nearest_neighbours(frame(spark, some), every=50, confidence=1 - 1e-9).collect())) for some in (rows, vectors(21, 120) + ODD)]
    assert near[0] == near[1] and {q for q, *_ in near[0]} == {0, 50, 100}


def test_usual_length_is_of_all_rows(spark, monkeypatch):
    table = lambda rows: frame(spark, [(k, v, 0) for k, v in enumerate(rows)])
    assert usual_length(table([[1.0, 2.0], [2.0, 1.0], [1.0] * 3, [0.0] * 4, [0.0] * 4, [0.0] * 4, None, [], [float("inf")] * 5, [None, 1.0]]), "embedding") == (2, 2)
    assert usual_length(table([[1.0], [1.0, 2.0]]), "embedding") == (2, 1) and usual_length(table([None, []]), "embedding") == (0, 0)
    # Among many rows without a vector a sample of rows may hold none.
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 20)
    got = linked_vectors(table([[1.0] * 16, [2.0] * 16] + [None] * 3000)).where("n_links > 0").collect()
    assert sorted((r.vec_id, r.component_id) for r in got) == [(0, 0), (1, 0)]


# URLs


def brute_rule(url: str | None, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({65 + i: 97 + i for i in range(26)}), m[2]) if m else ("", "")
    fits = []
    for h, p, action, tier in rules:
        right = re.match("(?s)" + re.escape(p).replace(r"\*", ".*"), path) if p else path == "" or path.startswith("/")
        if host and right and (not h or host == h or host.endswith("." + h)):
            fits.append((-tier, len(h + p), action == "block", h + p, action))
    return (host, path, *(max(fits)[3:] if fits else (None, None)))


def test_rules_equal_brute_force(spark):
    rules = [(*r, 0) for r in BASE_RULES] + [(*r, 1) for r in MORE_RULES] + [("a.b", "/x*y", "block", 1), ("", "/z", "allow", 1), ("b", "", "allow", 1), ("c-d.e", "/p.q/", "block", 1)]
    draw = random.Random(1)
    hosts = ["example.org", "EXAMPLE.org", "www.example.org", "badexample.org", "x.com", "com", "org", "a.b", "q.a.b", "b", "c-d.e", "cxd.e", "example.org:80", "u@example.org", ""]
    paths = ["", "/", "/es/1", "/en/1", "/en/12", "/en/2", "/fr/", "/de/x", "/xAAy", "/x\ny", "/z", "/zz?q", "/casino/1", "/a/casino/2", "/login/x", "/p.q/1", "/pxq/1", "?x=/es/", "#/es/", "//es/"]
    urls = [f"{draw.choice(['http', 'https', 'x'])}://{h}{p}{draw.choice(['', '?a=b', '#c'])}" for h in hosts for p in paths] + [None, "", "no scheme", "a://b://c/z", "http://", "http://www.example.org/es/" + "x" * 100_000]
    rows = [(k, u) for k, u in enumerate(urls)] + [(0, urls[0]), (0, urls[0]), (None, urls[3])]
    pages = spark.createDataFrame([(k, u, "t", "a", 3) for k, u in rows], "page_id bigint, url string, token string, action string, tier int")
    got = match_urls(pages, rules_table(spark, rules)).collect()
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.action) for r in got))) == sorted(map(str, ((k, *brute_rule(u, rules)) for k, u in rows)))
    assert max(r.n_candidates for r in got) < len(rules)
    assert all(r.rule is None for r in match_urls(pages, rules_table(spark, [])).collect()) and match_urls(pages.where("false"), rules_table(spark, rules)).count() == 0


def test_no_python_in_the_url_plan(spark, plan):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    text = plan(match_urls(spark.read.schema(pages.schema).parquet("/root/testdata/sf0.001/pages.parquet"), rules_table(spark, [("org", "/", "allow", 0)])))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


def test_url_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    df = entry.queries()["op5_url_filter"](spark, folder)
    cursor = connect(folder).execute(entry.oracle_sql()["op5_url_filter"])
    names = [c[0] for c in cursor.description]
    assert bag([tuple(r) for r in df.collect()], df.columns) == bag(cursor.fetchall(), names)


# Components


def test_components(spark):
    draw = random.Random(4)
    links = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1100)] + [(draw.randint(2000, 2100), draw.randint(2000, 2100)) for _ in range(60)] + [(5, 5), (None, 3), (7, None)]
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len(got) == len(root) and {r.node: r.component for r in got} == {x: find(x) for x in root}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
