"""The n-gram join and the neighbour search against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlab.llm import neighbours, ngram_join
from barlab.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + n]) for k in range(max(len(words) - n + 1, 1))) if words else frozenset()


def brute_components(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: root(i) for i in parent}


def near_copies(seed):
    """Families of near copies around the thresholds, and texts that share a passage."""
    rnd = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    rows, i = [], 100
    for family in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([4, 30, 60, 200]))]
        for _ in range(rnd.choice([1, 3, 25])):
            words = list(base)
            for _ in range(rnd.randrange(0, 1 + len(words) // 25)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            if rnd.random() < 0.2:
                words += passage
            rows.append((i, " ".join(words), "en", "s"))
            i += 1
    return rows


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(docs_of, odd_rows, n, percent):
    rows = near_copies(n) + odd_rows
    got = ngram_join.ngram_components(docs_of(rows), percent=percent, n=n).collect()
    expected = brute_components(rows, n, percent)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else expected[r.doc_id]), r
    sizes = {i: len(shingles(t, n)) for i, t, *_ in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got)
    assert 1 < len(set(expected.values())) < len(rows) - 20


def test_only_what_may_link_goes_with_a_token(spark, docs_of):
    join = ngram_join.NgramJoin(docs_of([]), "doc_id", "text", 90, 3, True)
    rows = [
        (1, 50, 0, 10), (1, 100, 0, 11),  # sizes too far apart
        (2, 100, 0, 20), (2, 100, 9, 21),  # the token comes too late for 95 common ones
        (3, 100, 0, 30), (3, 100, 5, 31),  # one pair
        (4, 20, 0, 40), (4, 100, 0, 41), (4, 105, 0, 42), (4, 200, 0, 43),
        (5, 100, 0, 50),
    ]
    postings = spark.createDataFrame(rows, "token long, n long, place int, doc_id long")
    got = {(r.token, r.doc_id, r.partner) for r in join._meetings(postings).collect()}
    assert got == {(3, 31, 30), (4, 41, None), (4, 42, None)}


@pytest.mark.parametrize("cell", [256, 5])
def test_all_links_equal_brute_force(docs_of, odd_rows, monkeypatch, cell):
    """Also those inside a component, in one cell and over many."""
    monkeypatch.setattr(ngram_join, "CELL", cell)
    template = [f"t{k}" for k in range(200)]
    dense = [(500 + k, " ".join([*template[: 4 * k], f"x{k}", *template[4 * k + 1 :]]), "en", "s") for k in range(30)]
    rows = near_copies(3) + odd_rows + dense
    sets = {}
    for i, t, *_ in rows:
        if i is not None and shingles(t, 3):
            sets[shingles(t, 3)] = min(i, sets.get(shingles(t, 3), i))
    near = lambda x, y: 100 * len(x & y) >= 90 * len(x | y)
    expected = sorted((min(i, j), max(i, j)) for x, i in sets.items() for y, j in sets.items() if i < j and near(x, y))
    got = ngram_join.ngram_links(docs_of(rows)).collect()
    assert sorted((min(a, b), max(a, b)) for a, b in got) == expected
    assert len(expected) > 30 * 29 / 2
    counted = ngram_join.ngram_components(docs_of(rows), count_links=True).collect()
    assert len(counted) == len(rows)
    texts = {i: t for i, t, *_ in rows}
    for r in counted:
        own = shingles(texts[r.doc_id], 3)
        count = sum(near(own, x) for x in sets if x != own) if own else 0
        assert r.n_links == (None if r.doc_id is None else count)


def test_one_document_of_each_group_stays(docs_of, odd_rows):
    rows = near_copies(9) + odd_rows
    docs = docs_of(rows)
    kept = ngram_join.keep_one(docs)
    expected = brute_components(rows, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(expected.values()))
    assert kept.filter("doc_id IS NULL").count() == 1


def test_trie_finds_what_pairwise_comparison_finds():
    rng = np.random.default_rng(3)
    universe = np.sort(rng.choice(1 << 40, 300, replace=False)).astype(np.uint64)
    query = np.sort(rng.choice(universe, 200, replace=False))
    sets = []
    for _ in range(60):
        change = rng.integers(0, 40)
        kept = rng.choice(query, len(query) - change, replace=False)
        sets.append(np.unique(np.append(kept, rng.choice(universe, rng.integers(0, 20)))))
    expected = [
        i
        for i, s in enumerate(sets)
        if 100 * len(np.intersect1d(s, query)) >= 80 * len(np.union1d(s, query))
    ]
    found = ngram_join.trie_links(query, [s.astype(">u8").tobytes() for s in sets], 80)
    assert sorted(found) == expected and 0 < len(expected) < 60


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()))
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(301)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_neighbours(rows, k):
    use = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    use = [(i, v) for i, v in use if np.isfinite(v).all() and v.any() and len(v) == 8]
    out = {}
    for i, v in use:
        if i % 20 == 0:
            scored = sorted(((-float((w * v).sum()), j) for j, w in use if j != i))[:k]
            out[i] = [j for _, j in scored]
    return out


def test_small_searches_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(100)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(200, None), (None, rows[0][1]), (220, [0.0] * 8), (240, []), (260, [float("nan")] * 8)]
    rows += [(280, [None, 1.0]), (300, [1.0, 2.0]), (320, [float("inf")] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = neighbours.search(table, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    expected = brute_neighbours(rows, 20)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == expected
    few = neighbours.search(table.limit(5).filter("vec_id < 5"), F.col("vec_id") == 0, k=20)
    assert few.count() == max(0, table.limit(5).filter("vec_id < 5").count() - 1)
    assert neighbours.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_learned_partitions_find_the_neighbours_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 250)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    points = centres[rng.integers(0, 40, 3000)] + 0.2 * rng.normal(size=(3000, 16))
    points[::3] = points[0]  # a third of all rows is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.search(table, F.col("vec_id") % 20 == 0, k=20).toPandas()
    hits = 0
    for q in range(0, 3000, 20):
        scores = (points * points[q]).sum(axis=1)
        scores[q] = -np.inf
        worst = np.sort(scores)[-20]
        found = got[got.query_id == q]
        assert len(found) == 20 and found.vec_id.is_unique
        hits += int((scores[found.vec_id] >= worst - 1e-9).sum())
    assert hits / (150 * 20) >= 0.9
    _, parts, probes = neighbours.learn(points, 3000, 20)
    assert parts > 4 and probes < parts


def test_one_document_stays_of_each_component_under_any_column_names(docs_of, odd_rows):
    text = " ".join(f"word{i}" for i in range(60))
    rows = odd_rows + [(30, text, "en", "s"), (31, text + " more", "en", "s"), (32, text, "en", None)]
    docs = docs_of(rows)
    plain = sorted(map(str, ngram_join.keep_one(docs).collect()))
    named = docs.withColumns({n: F.lit(1) for n in ("_id", "_ID_", "component_id", "n_links", "stays", "rows")})
    out = ngram_join.keep_one(named)
    assert out.columns == named.columns
    assert sorted(map(str, out.select(*docs.columns).collect())) == plain
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(30) == 1 and not {31, 32} & set(ids) and ids.count(5) == 1 and {None, 1, 2, 3} <= set(ids)
    empty = ngram_join.keep_one(docs_of([]))
    assert empty.columns == docs.columns and empty.count() == 0


def test_representatives_need_no_shuffle_of_prefixes(spark, docs_of, odd_rows):
    """Every set once, by the smallest id; an id with two texts stands only for the one it is smallest of."""
    rows = odd_rows + [(20, "one two three four", "en", "s"), (20, "p q r s", "en", "s"), (21, "p q r s", "en", "s")]
    join = ngram_join.NgramJoin(docs_of(rows), "doc_id", "text", 90, 3, True)
    found = join.representatives()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "LeftAnti" in plan
    keys = [(r.signature, r.doc_id) for r in found.collect()]
    wanted = [(r.signature, r.rep) for r in join.classes().collect()]
    assert set(keys) == set(wanted) and (20 in {i for _, i in keys}) and (21 not in {i for _, i in keys})


def test_only_sets_that_wide_bitmaps_leave_open_are_stored(docs_of, monkeypatch):
    """Long texts that meet by a chance token have no set on disk; nor are prefixes written twice."""
    phrase = "extraordinarily uncharacteristically incomprehensibilities counterrevolutionaries"
    rows = [(i, f"{phrase} " + " ".join(f"d{i}w{k}" for k in range(1500)), "en", "s") for i in range(20)]
    rows.append((100, rows[3][1] + " more", "en", "s"))
    stored, materialize = {}, ngram_join.materialize

    def recorded(df, label, *more):
        out = materialize(df, label, *more)
        stored.setdefault(label, []).append(out)
        return out

    monkeypatch.setattr(ngram_join, "materialize", recorded)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs_of(rows)).collect()}
    assert got == {i: i for i in range(20)} | {100: 3}
    assert {r.doc_id for t in stored["sets"] for r in t.collect()} == {3, 100}
    assert [k for k, ts in stored.items() if "prefix" in ts[0].columns] == ["profiles"]


def test_chance_tokens_alone_make_no_candidates(docs_of, monkeypatch):
    """Long texts that share two rare shingles are not compared; a near copy of one is."""
    phrases = ["extraordinarily uncharacteristically incomprehensibilities", "internationalization counterrevolutionary institutionalization"]
    text = lambda i: " ".join([phrases[0], *(f"d{i}w{k}" for k in range(700)), phrases[1], *(f"e{i}w{k}" for k in range(700))])
    rows = [(i, text(i), "en", "s") for i in range(12)] + [(100, text(3) + " more", "en", "s")]
    stored, materialize = {}, ngram_join.materialize

    def recorded(df, label, *more):
        out = materialize(df, label, *more)
        stored.setdefault(label, []).append(out)
        return out

    monkeypatch.setattr(ngram_join, "materialize", recorded)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs_of(rows)).collect()}
    assert got == {i: i for i in range(12)} | {100: 3}
    assert {r.doc_id for r in stored["candidates"][-1].collect()} <= {3, 100}


def test_sets_of_fewer_tokens_than_prefixes_must_share(docs_of):
    rnd = random.Random(11)
    rows = [(i, " ".join(rnd.choices("abcdefghijklmnopqrst", k=rnd.randrange(1, 6))), "en", "s") for i in range(14)]
    rows += [(50, "p1 p2", "en", "s"), (51, "p1", "en", "s"), (52, "q1 q2 q3", "en", "s"), (53, "q1 q2", "en", "s")]
    for percent in (50, 67):
        got = ngram_join.ngram_components(docs_of(rows), percent=percent, n=1).collect()
        assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 1, percent)
