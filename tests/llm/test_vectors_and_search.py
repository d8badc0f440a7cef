"""Range join, whitening and ranked search against plain versions on small made tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from storewright.llm import ball_search, range_join, whitening
from storewright.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>, node string, size string, component_id string, n long"
NAN, INF = float("nan"), float("inf")


def vector_table(spark, rows, partitions=3):
    """Rows with columns whose names clash with those that operators add."""
    return spark.createDataFrame([(i, v, "a", "b", "c", 1) for i, v in rows], VECTORS).repartition(partitions)


def odd_vectors(length):
    return [None, [], [0.0] * length, [NAN] + [1.0] * (length - 1), [INF] + [1.0] * (length - 1), [None] * length]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def plain_links(rows, cosine=0.9):
    vectors = [np.array(v) / np.linalg.norm(v) if usable(v) else None for _, v in rows]
    n, root = len(rows), list(range(len(rows)))
    links = [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            u, v = vectors[a], vectors[b]
            if u is not None and v is not None and len(u) == len(v) and float(u @ v) >= cosine:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(find(k)) if vectors[k] is not None else i
        out.append((i, links[k], c, i is not None and i == c))
    return sorted(out, key=repr)


def clustered(seed, length=6, groups=12, members=25):
    """Groups of all widths, chains between them, exact copies, vectors alone."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=length)
        centre /= np.linalg.norm(centre)
        for _ in range(members):
            rows.append((centre + rng.normal(size=length) * 0.02 * g) * rng.uniform(0.1, 9))
    start, end = rng.normal(size=(2, length))
    rows += [start + (end - start) * t for t in np.linspace(0, 1, 12)]
    rows += [rows[3]] * 40 + [rows[3] * 2.0] * 3
    rows += list(rng.normal(size=(40, length)))
    order = rng.permutation(len(rows))
    return [(int(i), rows[k].tolist()) for i, k in enumerate(order)]


@pytest.mark.parametrize(
    "spec",
    [
        range_join.RangeSpec(),
        range_join.RangeSpec(pivots=7, block=20, least_block=20),
        range_join.RangeSpec(pivots=40, block=16, least_block=1),
        range_join.RangeSpec(pivots=1, block=1000, least_block=1000),
    ],
)
def test_range_join(spark, spec):
    rows = clustered(3)
    odd = [(1000 + k, v) for k, v in enumerate(odd_vectors(6))]
    more = [(None, rows[0][1]), (None, None), (5, rows[9][1]), (2000, [1.0, 2.0]), (2001, [2.0, 4.0]), (2002, [3.0])]
    rows = rows + odd + more
    found = range_join.range_links(spark, vector_table(spark, rows), spec)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_links(rows)


def test_range_join_of_close_to_the_threshold(spark):
    """Pairs on both sides of 0.9 by less than single precision tells apart."""
    rows = [(0, [1.0, 0.0])]
    for k in range(1, 40):
        c = 0.9 + (k - 20) * 1e-9
        rows.append((k, [c, math.sqrt(1 - c * c)]))
    found = {r.vec_id: r.n_links for r in range_join.range_links(spark, vector_table(spark, rows)).collect()}
    want = {i: n for i, n, _, _ in plain_links(rows)}
    close = {20}  # 0.9 itself, where the last bit decides
    assert {i: n for i, n in found.items() if i not in close | {0}} == {i: n for i, n in want.items() if i not in close | {0}}
    assert abs(found[0] - want[0]) <= 1 and 18 <= found[0] <= 20


def test_range_join_compares_no_pairs_within_a_core(spark, monkeypatch):
    """A large group around a pivot is counted: no pair of it reaches the comparison."""
    rng = np.random.default_rng(0)
    rows = [(i, (np.eye(8)[0] + rng.normal(size=8) * 0.01).tolist()) for i in range(600)]
    copies = []

    def deal(layout, theta, real=range_join._copies):
        copies.append(layout)
        return real(layout, theta)

    monkeypatch.setattr(range_join, "_copies", deal)
    spec = range_join.RangeSpec(block=50, least_block=50)
    found = range_join.range_links(spark, vector_table(spark, rows), spec).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(599, 0)}
    (layout,) = copies
    assert layout.slices.max() == 12  # the core is cut, and none of its slices meet
    assert (layout.farthest[::2] >= 0).sum() == 1 and not (layout.farthest[1::2] >= 0).any()


def test_scaled_vectors_far_beyond_the_range_of_squares(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [1e300, -1e300]), (3, [5e-324, 5e-324])]
    found = sorted(map(tuple, range_join.range_links(spark, vector_table(spark, rows)).collect()))
    assert found == [(0, 2, 0, True), (1, 2, 0, False), (2, 0, 2, True), (3, 2, 0, False)]


# --- whitening -----------------------------------------------------------------


def plain_whitening(rows, components=16):
    taken = [(i, np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000) for i, v in rows if v and usable(v + [1.0])]
    lengths = Counter(len(x) for x in {tuple(x.tolist()) for _, x in taken})
    if not lengths:
        return [], None
    length = max(lengths, key=lambda k: (lengths[k], k))
    taken = [(i, x) for i, x in taken if len(x) == length]
    distinct = np.unique(np.stack([x for _, x in taken]), axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    z = (n * distinct - sums) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    return [(i, [int(v) for v in n * x - sums], (n * x - sums) / n) for i, x in taken], (n, values[::-1], vectors[:, ::-1])


def test_whitening_against_a_library_solver(spark):
    rng = np.random.default_rng(5)
    mixed = rng.normal(size=(20, 20)) * np.logspace(0, -1.5, 20)
    rows = [(i, (rng.normal(size=20) @ mixed).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)] + [(None, rows[8][1]), (3, rows[9][1])]
    rows += [(5000, None), (5001, []), (5002, [NAN] * 20), (5003, [INF] * 20), (5004, [None] * 20), (5005, [1.0, 2.0])]
    rows += [(5006, [0.0] * 20)]
    want, (n, values, vectors) = plain_whitening(rows)
    found = whitening.whiten(spark, vector_table(spark, rows)).collect()
    assert len(found) == 16 * len(want)
    assert {r.n for r in found} == {n} and max(r.identity_error for r in found) < 1e-9
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    exact = {}
    for i, z, _ in want:
        exact.setdefault(i, []).append(sum(v * v for v in z))
    assert {i: sorted(r.deviation for r in c[1]) for i, c in by_id.items()} == {i: sorted(d) for i, d in exact.items()}
    single = [(i, c) for i, _, c in want if len(exact[i]) == 1]
    got = np.array([[by_id[i][c][0].whitened for c in range(1, 17)] for i, _ in single])
    plain = np.stack([c for _, c in single]) @ vectors[:, :16] / np.sqrt(values[:16])
    plain *= np.sign((plain * got).sum(axis=0))
    assert np.abs(got - plain).max() < 1e-9
    explained = [by_id[single[0][0]][c][0].explained for c in range(1, 17)]
    assert np.allclose(explained, values[:16] / values.sum(), rtol=1e-10)


def test_components_are_as_many_as_the_rank(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-50, 50, size=(60, 2)) / 64
    rows = [(i, [a, b, a + b, 0.5]) for i, (a, b) in enumerate(base.tolist())]  # rank 2, a constant column
    found = whitening.whiten(spark, vector_table(spark, rows)).collect()
    assert Counter(r.component for r in found) == {1: 60, 2: 60} and found[0].identity_error < 1e-9
    assert abs(sum(r.explained for r in found) / 60 - 1) < 1e-9
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark, vector_table(spark, rows)).collect() == []


def test_eigenvalues_of_very_different_size():
    rng = np.random.default_rng(2)
    scale = np.logspace(0, -5, 12)
    factor = rng.normal(size=(12, 12)) * scale[:, None]
    values, vectors = whitening.eigen(factor @ factor.T)
    assert len(values) == 12 and (np.diff(values) <= 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-6
    low, order = whitening.pivoted_cholesky(factor @ factor.T)
    again = np.zeros((12, 12))
    again[np.ix_(order, order)] = low @ low.T
    assert np.allclose(again, factor @ factor.T, rtol=1e-9, atol=1e-30)
    u = whitening.one_sided_jacobi(low)
    assert np.allclose(np.sort((u * u).sum(axis=0)), np.sort(np.linalg.svd(low, compute_uv=False) ** 2), rtol=1e-10)


def test_large_entries_stay_exact():
    centre = whitening.Centre(3_000_000_000, [7 * 10**12, -5])
    x = np.array([[1234, -2], [2**40, 0], [2333, 1]], np.int64)
    want = [sum((centre.n * v - s) ** 2 for v, s in zip(row, centre.sums, strict=True)) for row in x.tolist()]
    assert centre.deviations(x) == [w if w < 2**63 else None for w in want]
    assert [whitening.unpack_vectors([whitening.pack_vector(r)])[0].tolist() for r in x] == x.tolist()


# --- ranked search -------------------------------------------------------------

PLAIN_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return PLAIN_TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k=10):
    texts = [(i, plain_terms(t)) for i, t in docs]
    texts = [(i, t) for i, t in texts if t]
    n_docs, n_terms = len(texts), sum(len(t) for _, t in texts)
    holding = Counter(w for _, t in texts for w in set(t))
    largest = {}
    for i, t in items:
        if i is not None:
            largest[i] = max(largest.get(i, ""), t or "")
    out = []
    for item, text in largest.items():
        scores = []
        for i, t in texts:
            counts, score = Counter(t), 0
            m = 10 + 90 * len(t) * n_docs // n_terms
            for w in set(plain_terms(text)) & set(counts):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[w] + 1)))
                score += weight * (1_000_000_000 * counts[w] // (1000 * counts[w] + 8 * m))
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "日本", "naïve", "A-b", "x_y", "don't", "42"]
    def text(n):
        return " ".join(rng.choice(words[: rng.choice([5, 20, len(words)])]) + rng.choice(["", ".", "\n"]) for _ in range(n))
    docs = [(i, text(rng.choice([0, 1, 5, 30, 200]))) for i in range(300)]
    docs += [(400 + i, docs[7][1]) for i in range(40)] + [(None, docs[9][1]), (9, docs[10][1]), (9, docs[10][1])]
    docs += [(500, None), (501, ""), (502, " \n-_"), (503, "w1 " * 3000)]
    items = [(i, text(rng.choice([1, 3, 10, 25]))) for i in range(40)]
    items += [(3, "w1"), (None, "w2"), (50, None), (51, ""), (52, "unheard of"), (53, docs[7][1]), (54, "W1 w1 É")]
    return docs, items


def search_tables(spark, docs, items):
    documents = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id long, terms string")
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id long, part long")
    return documents.repartition(3), asked


@pytest.mark.parametrize(
    "spec",
    [
        ball_search.SearchSpec(),
        ball_search.SearchSpec(group_terms=5, docs=17, leaf=1),
        ball_search.SearchSpec(cells=30, leaf=2),
        ball_search.SearchSpec(part_bytes=300, leaf=4),
    ],
)
def test_search(spark, texts, spec):
    docs, items = texts
    found = ball_search.search(spark, *search_tables(spark, docs, items), spec)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == plain_search(docs, items)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 10**10, size=(8, 30))
    rows = np.abs(centres[rng.integers(0, 8, 900)] + rng.integers(-(10**8), 10**8, size=(900, 30)))
    items = (rng.random((30, 20)) < 0.3).astype(float)
    tree = ball_search.BallTree(rows, 8)
    bounds, products = tree.bounds(items), tree.rows @ items.astype(np.int64)
    for (begin, end), bound in zip(tree.spans, bounds, strict=True):
        assert (products[begin:end].max(axis=0) <= bound).all()
    assert sorted(tree.order.tolist()) == list(range(900)) and (tree.rows == rows[tree.order]).all()
    for j in range(20):
        best = ball_search.Best(10)
        scored = ball_search.descend(tree, tree.order, np.flatnonzero(items[:, j]), bounds[:, j].tolist(), best)
        assert scored < 450 or items[:, j].sum() == 0
        assert best.scores.tolist() == sorted(products[:, j].tolist(), reverse=True)[:10] or items[:, j].sum() == 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["ab", " ", "É", "x1", "-", "日"]) for _ in range(5000))
    whole = ball_search.count_terms(text)
    monkeypatch.setattr(ball_search, "SLICE", 7)
    assert ball_search.count_terms(text) == whole
    terms = plain_terms(text)
    assert whole == (len(terms), Counter(t.encode() for t in terms))


def test_items_are_grouped_whole():
    rng = np.random.default_rng(3)
    items = [np.unique(rng.integers(0, 200, rng.integers(1, 30))) for _ in range(60)]
    groups = ball_search.group_items(items, 200, 40)
    assert sorted(i for g in groups for i in g) == list(range(60))
    assert all(len(g) == 1 or len(np.unique(np.concatenate([items[i] for i in g]))) <= 40 for g in groups)


def test_empty_tables(spark):
    docs, items = search_tables(spark, [], [])
    one_doc, one_item = search_tables(spark, [(1, "a b")], [(1, "b")])
    for pair in ((docs, items), (docs, one_item), (one_doc, items)):
        found = ball_search.search(spark, *pair)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []
    assert range_join.range_links(spark, vector_table(spark, [])).collect() == []


def test_queries_are_registered():
    wanted = {"op11_metric_range_join", "op12_whitening", "op13_ball_tree_search"}
    assert wanted <= QUERIES.keys() and QUERIES.keys() <= entry.queries().keys()
    assert {"op11_metric_range_join", "op13_ball_tree_search"} <= entry.oracle_sql().keys()
