"""Ranked search and license scan against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from barlab.llm import lexical, licenses, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(LOWER) for w in TERM.findall(text or "")]


def brute_rank(docs, items, k):
    held = [(i, Counter(w), len(w)) for i, t, *_ in docs if (w := words(t))]
    many, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 75 + 25 * n * many // length
            score = 0
            for t in words(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        found += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=str)


def corpus(seed, many):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = []
    for i in range(many):
        text = " ".join(rnd.choices(vocabulary, weights, k=rnd.choice([1, 5, 30, 200])))
        rows.append((i, text, "en", "hot" if i % 3 else "s"))
    rows += [(1000 + i, rows[5][1], "en", "s") for i in range(100)]  # many copies: ties by id
    return rows


@pytest.mark.parametrize(("k", "seed", "most_items", "most_terms"), [(20, 32, 512, 16384), (3, 1, 2, 16384), (7, 2, 512, 10)])
def test_ranks_equal_brute_force(spark, docs_of, odd_rows, k, seed, most_items, most_terms):
    rows = corpus(k, 400) + [(r[0] if r[0] is None else r[0] + 5000, *r[1:]) for r in odd_rows]
    rnd = random.Random(9)
    items = [(i, " ".join(rnd.choices([f"W{j}" for j in range(320)], k=rnd.choice([1, 4, 40])))) for i in range(9)]
    items += [(90, None), (91, ""), (92, "none of these 中文"), (93, "w1 w1 W1-w2"), (None, "w5"), (1, rows[5][1])]
    table = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, item string, rank int")
    got = lexical.rank(docs_of(rows), table, k=k, seed=seed, most_items=most_items, most_terms=most_terms)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute_rank(rows, items, k)


def test_ranking_of_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(docs_of([]), items).count() == 0
    assert lexical.rank(docs_of([(1, None, "en", "s")]), items).count() == 0
    assert lexical.rank(docs_of([(1, "a", "en", "s")]), items.limit(0)).count() == 0


def test_the_dual_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(3)
    size, many = 200, 4000
    weights = [(np.sort(rng.choice(size, 12, replace=False)), rng.integers(1, 9000, 12)) for _ in range(30)]
    tree = lexical.DualTree(weights, size, 5, np.zeros(30, np.int64))
    dense = np.where(rng.random((many, size)) < 0.05, rng.integers(1, 10**6, (many, size)), 0)
    for first in range(0, many, 500):
        doc, term = np.nonzero(dense[first : first + 500])
        ids = np.arange(first, min(first + 500, many))
        tree.offer(ids, np.zeros(len(ids), bool), doc, term, dense[first : first + 500][doc, term])
    for (at, w), (score, ids, _) in zip(weights, tree.best, strict=True):
        exact = dense[:, at] @ w
        order = np.lexsort((np.arange(many), -exact))[:5]
        assert score.tolist() == exact[order].tolist() and ids.tolist() == order.tolist()
    assert tree.scored < 0.7 * many * len(weights)


# --- licenses -----------------------------------------------------------------------------


def brute_licenses(text, templates, percent):
    w = words(text)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    found, share = set(labels), 0.0
    for label, text_ in templates:
        own = words(text_)
        width = 1
        while width < len(own):
            width *= 2
        own = set(own)
        for start in range(0, len(w), width):
            both = len(own & set(w[start : start + 2 * width]))
            if both >= max(1, -(-len(own) * percent // 100)):
                found.add(label)
                share = max(share, both / len(own))
    score = 1.0 if places else share
    ends = (min(places), max(places)) if places else (None, None)
    return (len(w), len(places), *ends, ",".join(sorted(labels)), ",".join(sorted(found)), score)


@pytest.mark.parametrize("percent", [90, 60, 100])
def test_licenses_equal_brute_force(docs_of, odd_rows, percent):
    rnd = random.Random(percent)
    rows = list(odd_rows)
    for i in range(150):
        label, text = rnd.choice(licenses.TEMPLATES)
        own = text.split()
        for _ in range(rnd.choice([0, 1, 2, len(own) // 4])):
            own[rnd.randrange(len(own))] = rnd.choice(["the", "zzz", "License"])
        filler = [rnd.choice(["the", "a", "of", "license", "le", "der", "software"]) for _ in range(rnd.choice([0, 3, 200]))]
        cut = rnd.randrange(len(filler) + 1)
        rows.append((100 + i, " ".join(filler[:cut] + own + filler[cut:]), "en", "hot"))
    rows += [
        (300, "CC-BY cc by the MIT\nLicense; GNU  General.Public license", "en", "s"),
        (301, "mit", "en", "s"),
        (302, "license mit license mit license", "en", "s"),
    ]
    got = licenses.digest(licenses.scan(docs_of(rows), percent=percent))
    expected = [(r[0], *brute_licenses(r[1], licenses.TEMPLATES, percent)) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_every_matching_block_is_found(docs_of):
    text = "x " * 40 + licenses.TEMPLATES[1][1] + " y" * 40
    documents, found = licenses.scan(docs_of([(1, text, "en", "s"), (2, text * 3, "en", "s"), (3, None, "en", "s")]))
    by_row = {r.row: r.doc_id for r in documents.collect()}
    blocks = sorted((by_row[r.row], r.label, r.start, r.shared, r["size"]) for r in found.collect())
    assert [b for b in blocks if b[0] == 1] == [(1, "mit", 32, 5, 5), (1, "mit", 40, 5, 5)]
    assert len([b for b in blocks if b[0] == 2]) >= 3 and not [b for b in blocks if b[0] == 3]
    assert licenses.digest(licenses.scan(docs_of([]))).count() == 0


def test_clean_prose_has_no_label(docs_of):
    prose = "The license of a driver is issued by the office under the rules of the state; a copy costs a fee. " * 50
    (row,) = licenses.digest(licenses.scan(docs_of([(1, prose, "en", "s")]))).collect()
    assert (row.n_base, row.labels, row.score, row.first_word) == (0, "", 0.0, None)


def test_words_are_cut_like_the_pattern():
    for text in ["", "a", "É_b-c9", "x\x00y", "ß中文 A", "a\x7fb\u0085c", "[a]{b}`c@d/e:f"]:
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, firsts = terms.spans(data, np.array([0, len(data)]))
        cut = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
        assert cut == TERM.findall(text) and firsts.tolist() == [0, len(cut)]
