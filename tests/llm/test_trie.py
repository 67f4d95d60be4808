"""The conversation trie against a dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barlab.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, hash string, seg long, place long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, 7) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            name = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), name, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, convs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1]) if p else 0
    found = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(rebuilt[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.append((convs[0], len(p), parent, len(convs), children[p], leaves[p], saved[p], sha))
    return sorted(found, key=str)


def conversations(seed, many, longest):
    """Few different turns, so that prefixes are shared; copies, a hot first turn, repeated turn numbers."""
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(700), many):
        like = rnd.choice([None, 3])
        for turn in range(rnd.choice([1, 2, 3, longest])):
            text = "hot" if turn == 0 or like else rnd.choice(["a", "bé", "", None])
            rows.append((c, rnd.choice([turn, turn, None]), rnd.choice(["u", "u", None]), text))
    return rows


@pytest.mark.parametrize(("width", "cells", "rows"), [(256, 1 << 20, 1 << 16), (3, 40, 7), (1, 8, 3), (2, 1 << 20, 1)])
def test_every_node_equals_brute_force(spark, width, cells, rows):
    data = conversations(width, 90, 11)
    got = prefix_trie.trie(table(spark, data), width=width, cells=cells, rows=rows, parts=5)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(data)


def test_copies_over_many_ranges(spark):
    """Most conversations are copies of one, longer than a segment: their node ends are hashed in order."""
    data = [(c, t, "u", f"turn {t}") for c in range(1, 400) for t in range(5)]
    data += [(c, t, "u", f"turn {t}" if t < 4 else f"own {c % 7}") for c in range(1000, 1100) for t in range(7)]
    got = prefix_trie.trie(table(spark, data), width=2, cells=60, rows=20, parts=6).collect()
    assert sorted(map(tuple, got), key=str) == brute(data)


def test_odd_rows(spark):
    data = [
        (None, 0, "u", "left out"),
        (100, None, None, None),
        (101, 0, "u", "only"),
        (101, 0, "u", "only"),
        (205, 3, "u", "x" * 100_000),
        (205, 1 << 40, "a", "far"),
        (205, -5, "a", "\U0001f600 first"),
        (-7, 0, "u", "negative"),
        (309, 0, "u", "base is absent"),
    ] + [(100, t, "u", f"t{t}") for t in range(3000)]
    data += [(150, t, "u", f"t{t}") for t in range(2500)]
    got = prefix_trie.trie(table(spark, data), width=512, parts=4).collect()
    expected = {r[:2] + r[3:]: r for r in linear(data)}
    assert {tuple(r)[:2] + tuple(r)[3:]: tuple(r) for r in got} == expected
    assert prefix_trie.trie(table(spark, [])).count() == 0
    lone = prefix_trie.trie(table(spark, [(309, 0, "u", "x")])).collect()
    assert sorted(map(tuple, lone), key=str) == brute([(309, 0, "u", "x")])


def linear(rows):
    """Brute force whose prefixes are hashes, for long conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            name = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), name, role or "", text or ""))
    own = {c: sorted(t) for c, t in own.items()}
    members, parent_of, size, ends, depth = defaultdict(list), {}, {}, defaultdict(list), {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        key = b""
        members[key].append(c)
        depth[key] = 0
        for d, t in enumerate(own.get(c - c % 100, [])[:h] + own[c][h:], 1):
            below = hashlib.md5(key + t[1].encode()).digest()
            parent_of[below], size[below], depth[below] = key, len(t[3]), d
            members[below].append(c)
            key = below
        ends[key].append(c)
    children = defaultdict(int)
    for p in parent_of.values():
        children[p] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=lambda p: -depth[p]):
        leaves[p] += not children[p]
        saved[p] += (len(members[p]) - 1) * size.get(p, 0)
        if p in parent_of:
            leaves[parent_of[p]] += leaves[p]
            saved[parent_of[p]] += saved[p]
    for p, convs in members.items():
        sha = hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()
        up = members[parent_of[p]][0] if p in parent_of else None
        yield convs[0], depth[p], up, len(convs), children[p], leaves[p], saved[p], sha


def test_shards_are_bounded(spark):
    """A hot conversation text is dealt in ranges: no shard holds more rows than allowed."""
    import pyarrow as pa

    end = b"\xff" * prefix_trie.TURN
    batch = pa.RecordBatch.from_arrays([pa.array([b"x" * prefix_trie.TURN * n + end for n in [1, 1, 9, 2, 2, 2, 30]])], names=["path"])
    shards = list(prefix_trie._shards(iter([batch, batch]), cells=20, rows=3))
    assert sum(s.num_rows for s in shards) == 14
    for s in shards:
        lens = [len(p) // prefix_trie.TURN - 1 for p in s["path"].to_pylist()]
        assert len(lens) == 1 or len(lens) * max(lens) <= 20 and len(lens) <= 3


def test_turns_are_numbered_in_order(spark):
    data = [(c, t, "u", f"t{t}") for c in (100, 101) for t in range(3)]
    numbered = prefix_trie.turns(table(spark, data))
    assert sorted(map(tuple, numbered.select("conv_id", "place").collect())) == sorted((c, t + 1) for c, t, *_ in data)
    assert numbered.filter(F.col("place") < 1).count() == 0
