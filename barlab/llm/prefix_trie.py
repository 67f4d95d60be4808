"""The trie of conversation prefixes, from sorted matrices of turn ids.

Each conversation c is rebuilt first: the first h turns of conversation c - c % 100, then its own turns
after its first h, where h = crc32(c as text) % 6. A node of depth d is a distinct sequence of first d
rebuilt turns (role and text); the root has depth 0. Texts leave the first scan as 128-bit hashes and
lengths in code points.

A rebuilt conversation is cut into segments of ``WIDTH`` turns; a segment is known by a hash of all
turns before it, so that the nodes below it are a trie of their own. Segments are sorted by that hash, by
their turns (a conversation that ends follows those that go on) and by id, and dealt in ranges. A task
takes shards of consecutive segments as padded matrices of turn ids: a lexsort orders them, the masks of
columns that change, OR-accumulated from left to right, mark where nodes start, and reduceat sums every
depth. Counts are sums over rows, or over starts:

* members and their smallest id: rows;
* children and leaves: starts (the first row of a node ends there only if all its rows do);
* saved code points of a subtree: those of all its rows, less those of the nodes started.

So shards add up: a shard knows the last row of the one before it, and nodes that reach a shard's first
or last row are added by key. At a range's first row the starts that belong to the range before are taken
off again. What deeper segments hold is first counted per row (the row that starts a node has its leaf and
its length) and enters the sums of the segments above as weights. The ids of a node's last members are
hashed piece by piece, in order.

Turns are numbered by counts per block of 1 024 turn numbers, so that a long conversation is numbered by
many tasks; what goes to one task is a range of rows, whatever they share. Only the ids that end at one
node meet in one task, as pieces of up to ``ROWS`` ids, since their hash is serial by definition.

Defined results: rows without conv_id are left out; NULL roles and texts are empty; turns are ordered by
number, NULL first, rows of one number by a hash of role and text, and repeated rows are repeated turns;
a rebuilt conversation without turns is a member of the root alone; further columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.shared import need, prepare, shuffle_parts
from barlab.session import materialize

WIDTH = 256
ROWS = 1 << 16
CELLS = 4 << 20
TURN = 16
_ENDS, _GOES_ON = b"\xff" * TURN, b"\x00" * TURN
_NUMBERS_BITS = 10
_NOTHING = hashlib.sha256(b"").hexdigest()
_ROOT = "root"

_SEGMENT = ["conv_id", "seg", "key", "next_key", "path", "chars", "more", "w_children", "w_leaves", "w_distinct", "w_member"]
_NODE = (
    "kind string, node_key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, member_chars long, distinct_chars long, ends string, first_id long, ids string"
)
_EDGE = (
    "part int, seg long, first_key string, first_path binary, first_chars array<long>, first_more boolean, "
    "last_key string, last_path binary"
)
_OUT = f"{_NODE}, {_EDGE}"
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
_FIELDS = [
    (name, _ARROW.get(kind, pa.list_(pa.int64()))) for name, kind in (part.split(" ", 1) for part in _OUT.split(", "))
]
_MADE = pa.schema(_FIELDS)


def _batch(**columns) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    given = {k: v if isinstance(v, pa.Array) else pa.array(v, dict(_FIELDS)[k]) for k, v in columns.items()}
    arrays = [given[n].cast(t) if n in given else pa.nulls(rows, t) for n, t in _FIELDS]
    return pa.RecordBatch.from_arrays(arrays, schema=_MADE)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else _NOTHING


def node_key(key: str, path: bytes, depth: int, width: int, next_key: str | None) -> str:
    """The name of a node: by the hash of its turns, or, at a segment's end, that of the segment below."""
    if depth == 0 and not key:
        return _ROOT
    if depth == width:
        return next_key
    return f"{key}:{hashlib.md5(path[: depth * TURN]).hexdigest()}"


def shared_turns(a: bytes, b: bytes) -> int:
    """How many first turns two paths share."""
    n = min(len(a), len(b)) // TURN
    x, y = (np.frombuffer(p[: n * TURN], f"V{TURN}") for p in (a, b))
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


class _Shard:
    """A padded matrix of consecutive segments and where its nodes start."""

    def __init__(self, table: pa.Table, before: tuple[str, bytes] | None):
        self.conv, self.seg = (table[c].to_numpy() for c in ("conv_id", "seg"))
        self.key, self.next_key = table["key"].to_pylist(), table["next_key"].to_pylist()
        self.path = [p[:-TURN] for p in table["path"].to_pylist()]
        self.more = table["more"].to_numpy()
        self.weights = {c: table[c].to_numpy() for c in ("w_children", "w_leaves", "w_distinct", "w_member")}
        self.lens = np.array([len(p) // TURN for p in self.path])
        self.rows, self.width = len(self.path), int(self.lens.max())
        turns = np.frombuffer(b"".join(self.path), f"S{TURN}")
        known, flat = np.unique(turns, return_inverse=True)
        inside = np.arange(self.width) < self.lens[:, None]
        ids = np.full((self.rows, self.width), len(known))  # padding follows every turn
        ids[inside] = flat
        chars = np.zeros((self.rows, self.width), np.int64)
        chars[inside] = table["chars"].combine_chunks().flatten().to_numpy()
        _, keys = np.unique(np.array(self.key), return_inverse=True)
        order = np.lexsort((self.conv, ~self.more, *ids.T[::-1], keys))
        self._reorder(order)
        self.ids, self.chars, self.inside = ids[order], chars[order], inside[order]
        keys = keys[order]
        new_key = np.concatenate(([True], keys[1:] != keys[:-1]))
        change = np.empty((self.rows, self.width + 1), bool)
        change[:, 0] = new_key
        change[0, 1:] = True
        change[1:, 1:] = self.ids[1:] != self.ids[:-1]
        self.bounds = np.logical_or.accumulate(change, axis=1)
        self.starts = self.bounds[:, 1:] & self.inside
        if before is not None and before[0] == self.key[0]:
            self.starts[0, : shared_turns(before[1], self.path[0])] = False

    def _reorder(self, order: np.ndarray) -> None:
        for name in ("conv", "seg", "more", "lens"):
            setattr(self, name, getattr(self, name)[order])
        for name in ("key", "next_key", "path"):
            values = getattr(self, name)
            setattr(self, name, [values[i] for i in order])
        self.weights = {k: v[order] for k, v in self.weights.items()}

    def last(self) -> tuple[str, bytes]:
        return self.key[-1], self.path[-1]

    def leaf_starts(self) -> np.ndarray:
        ends = np.zeros(self.rows, bool)
        real = np.flatnonzero((self.lens > 0) & ~self.more)
        ends[real] = self.starts[real, self.lens[real] - 1]
        return ends.astype(np.int64)

    def per_row(self) -> pa.RecordBatch:
        """What every row starts: its first node, a leaf, and code points."""
        return _batch(
            kind=["row"] * self.rows,
            conv_id=self.conv,
            seg=self.seg,
            n_children=self.starts[:, 0].astype(np.int64),
            n_leaves=self.leaf_starts(),
            distinct_chars=np.where(self.starts, self.chars, 0).sum(axis=1),
        )

    def _name(self, row: int, depth: int, width: int) -> str:
        return node_key(self.key[row], self.path[row], depth, width, self.next_key[row])

    def nodes(self, width: int) -> Iterator[pa.RecordBatch]:
        leaves = self.leaf_starts() + self.weights["w_leaves"]
        after = np.zeros((self.rows, self.width + 2), np.int64)  # children by the depth of their parent
        after[:, : self.width] = self.starts
        after[np.arange(self.rows), self.lens] += np.where(self.more, self.weights["w_children"], 0)
        member = np.zeros((self.rows, self.width + 1), np.int64)
        member[:, :-1] = self.chars[:, ::-1].cumsum(axis=1)[:, ::-1]
        distinct = np.zeros((self.rows, self.width + 1), np.int64)
        distinct[:, :-1] = np.where(self.starts, self.chars, 0)[:, ::-1].cumsum(axis=1)[:, ::-1]
        member += self.weights["w_member"][:, None]
        distinct += self.weights["w_distinct"][:, None]
        whole = np.cumsum(self.bounds[:, -1]) - 1  # rows of equal turns in one segment trie
        ended = np.flatnonzero(~self.more)
        upper_first, upper_conv, upper_open = np.zeros(0, np.int64), None, None
        for depth in range(self.width + 1):
            first = np.flatnonzero(self.bounds[:, depth])
            end = np.append(first[1:], self.rows)
            if depth:
                real = self.inside[first, depth - 1]
            else:
                real = np.array([not self.key[r] for r in first])
            conv = np.minimum.reduceat(self.conv, first)
            total = end - first
            column = max(depth - 1, 0)
            summed = (after[:, depth], leaves, member[:, column], distinct[:, column])
            sums = [np.add.reduceat(x, first) for x in summed]
            wide = (first == 0) | (end == self.rows) | (depth == width)
            if depth == 0:
                wide[:] = True
            here = np.flatnonzero(real)
            up = np.searchsorted(upper_first, first[here], side="right") - 1
            # Rows that end at this depth, by node.
            own = ended[self.lens[ended] == depth]
            run = np.flatnonzero(np.concatenate(([True], whole[own][1:] != whole[own][:-1]))) if len(own) else own
            groups = (np.searchsorted(first, own[run], side="right") - 1).tolist()
            runs = dict(zip(groups, np.split(own, run[1:]) if len(own) else [], strict=True))
            texts = {g: ",".join(map(str, self.conv[r].tolist())) for g, r in runs.items()}
            names = {int(g): self._name(first[g], depth, width) for g in here[wide[here]]}
            pieces = [(names[g], int(self.conv[r[0]]), texts[g]) for g, r in runs.items() if g in names]
            if pieces:
                node, low, ids = zip(*pieces, strict=True)
                yield _batch(kind=["piece"] * len(pieces), node_key=node, first_id=low, ids=ids)
            if len(here):
                if depth == 0:
                    parent_key, parent = [None] * len(here), [None] * len(here)
                elif depth == 1:
                    # The root, or the end of the segment above, which has the name of this segment.
                    parent_key = [self.key[r] or _ROOT for r in first[here]]
                    parent = [None] * len(here)
                else:
                    known = ~upper_open[up]
                    rows = zip(known, first[here], strict=True)
                    parent_key = [None if k else self._name(r, depth - 1, width) for k, r in rows]
                    parent = pa.array(upper_conv[up], mask=~known)
                yield _batch(
                    kind=["open" if g in names else "node" for g in here.tolist()],
                    node_key=[names.get(g) for g in here.tolist()],
                    parent_key=parent_key,
                    conv_id=conv[here],
                    depth=self.seg[first[here]] * width + depth,
                    parent_conv_id=parent,
                    n_convs=total[here],
                    n_children=sums[0][here],
                    n_leaves=sums[1][here],
                    member_chars=sums[2][here],
                    distinct_chars=sums[3][here],
                    ends=[None if g in names else _sha256(texts.get(g, "")) for g in here.tolist()],
                )
            upper_first, upper_conv, upper_open = first, conv, wide


def _shards(batches: Iterator[pa.RecordBatch], cells: int, rows: int) -> Iterator[pa.Table]:
    """Consecutive rows whose padded matrix has at most ``cells`` cells (or a single row)."""
    held: list[pa.RecordBatch] = []
    count = widest = 0
    for batch in batches:
        lens = pc.binary_length(batch.column("path")).to_numpy() // TURN - 1
        first = 0
        for i, n in enumerate(lens):
            if count and ((count + 1) * max(widest, n) > cells or count == rows):
                held.append(batch.slice(first, i - first))
                yield pa.Table.from_batches(held)
                held, first, count, widest = [], i, 0, 0
            count, widest = count + 1, max(widest, n)
        held.append(batch.slice(first))
    if count:
        yield pa.Table.from_batches(held)


def _work(width: int, per_row: bool, cells: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = edge = None
        for table in _shards(batches, cells, rows):
            shard = _Shard(table, before)
            if edge is None:
                edge = {
                    "kind": ["edge"],
                    "part": [TaskContext.get().partitionId()],
                    "conv_id": shard.conv[:1],
                    "seg": shard.seg[:1],
                    "first_key": shard.key[:1],
                    "first_path": shard.path[:1],
                    "first_chars": [shard.chars[0, : shard.lens[0]].tolist()],
                    "first_more": shard.more[:1],
                    "node_key": shard.next_key[:1],
                }
            before = shard.last()
            if per_row:
                yield shard.per_row()
            else:
                yield from shard.nodes(width)
        if edge is not None:
            yield _batch(**edge, last_key=[before[0]], last_path=[before[1]])

    return run


def _taken_off(width: int, per_row: bool):
    """Rows that take off the starts which a range's first row shares with the range before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["prev_key"] is None or r["prev_key"] != r["first_key"]:
                    continue
                path, key = r["first_path"], r["first_key"]
                shared, chars = shared_turns(r["prev_path"], path), r["first_chars"]
                leaf = int(shared > 0 and len(chars) == shared and not r["first_more"])
                if per_row:
                    yield _batch(
                        kind=["row"], conv_id=[r["conv_id"]], seg=[r["seg"]], n_children=[-int(shared > 0)],
                        n_leaves=[-leaf], distinct_chars=[-sum(chars[:shared])],
                    )
                    continue
                depths = list(range(0 if not key else 1, shared + 1))
                if depths:
                    yield _batch(
                        kind=["open"] * len(depths),
                        node_key=[node_key(key, path, d, width, r["node_key"]) for d in depths],
                        n_convs=[0] * len(depths),
                        n_children=[-int(d < shared) for d in depths],
                        n_leaves=[-leaf] * len(depths),
                        member_chars=[0] * len(depths),
                        distinct_chars=[-sum(chars[max(d - 1, 0) : shared]) for d in depths],
                    )

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 per key of pieces that arrive in order, comma-joined."""
    key, state = None, None
    for batch in batches:
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if name != key:
                if state is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["node_key", "hashed"])
                key, state = name, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["node_key", "hashed"])


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, hash, chars) of all turns, in order."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    slim = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long").alias("turn"),
        F.md5(named).alias("hash"),
        F.length(text).cast("long").alias("chars"),
    )
    slim = slim.withColumn("block", F.coalesce(F.shiftright("turn", _NUMBERS_BITS), F.lit(-(1 << 62))))
    slim = materialize(slim, "turns")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = slim.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(earlier)).filter(F.col("before") > 0).drop("n")
    order = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "hash")
    numbered = slim.withColumn("place", F.row_number().over(order)).join(before, ["conv_id", "block"], "left")
    place = F.col("place") + F.coalesce("before", F.lit(0))
    return numbered.select("conv_id", place.cast("long").alias("place"), "hash", "chars")


def segments(conversations: DataFrame, width: int) -> DataFrame:
    """(conv_id, seg, total, hashes, chars) of all rebuilt conversations, one row per ``width`` turns."""
    own = materialize(turns(conversations), "numbered-turns")
    cut = F.crc32(F.col("conv_id").cast("string")) % 6
    base_id = F.col("conv_id") - F.col("conv_id") % 100
    bases = (
        own.filter((F.col("conv_id") % 100 == 0) & (F.col("place") <= 5))
        .groupBy(F.col("conv_id").alias("base_id"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "hash", "chars"))).alias("base"))
    )
    sizes = own.groupBy("conv_id").agg(F.max("place").alias("own_turns")).withColumn("base_id", base_id)
    known = sizes.join(bases, "base_id", "left").withColumn("cut", cut)
    taken = F.least("cut", F.coalesce(F.size("base"), F.lit(0))).cast("long")
    known = known.withColumn("taken", F.when(F.col("base").isNull(), 0).otherwise(taken))
    total = F.col("taken") + F.greatest(F.col("own_turns") - F.col("cut"), F.lit(0))
    known = materialize(known.select("conv_id", "cut", "taken", total.alias("total"), "base"), "rebuilt")
    first = known.select("conv_id", "total", F.explode(F.slice("base", F.lit(1), F.col("taken").cast("int"))).alias("t"))
    first = first.select("conv_id", "total", "t.*")
    rest = own.join(known.drop("base"), "conv_id").filter(F.col("place") > F.col("cut"))
    rest = rest.select("conv_id", "total", (F.col("place") - F.col("cut") + F.col("taken")).alias("place"), "hash", "chars")
    seg = F.expr(f"(place - 1) div {width}")
    full = (
        first.union(rest)
        .groupBy("conv_id", seg.alias("seg"))
        .agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("place", "hash", "chars"))).alias("turns"))
        .select("conv_id", "seg", "total", F.col("turns.hash").alias("hashes"), F.col("turns.chars").alias("chars"))
    )
    none = known.filter("total = 0").select(
        "conv_id", F.lit(0).cast("long").alias("seg"), "total",
        F.array().cast("array<string>").alias("hashes"), F.array().cast("array<long>").alias("chars"),
    )
    return full.union(none)


def _sharded(segs: DataFrame, parts: int) -> DataFrame:
    ranged = segs.select(*_SEGMENT).repartitionByRange(parts, "key", "path", "conv_id")
    return ranged.sortWithinPartitions("key", "path", "conv_id")


def _corrected(made: DataFrame, kind: str, width: int, per_row: bool) -> DataFrame:
    """The stored rows of a kind, with what the edges of ranges take off. One row per range meets in a window."""
    edges = made.filter("kind = 'edge'")
    order = Window.orderBy("part")
    edges = edges.withColumn("prev_key", F.lag("last_key").over(order)).withColumn("prev_path", F.lag("last_path").over(order))
    return made.filter(F.col("kind") == kind).union(edges.mapInArrow(_taken_off(width, per_row), _OUT))


def trie(
    conversations: DataFrame, width: int = WIDTH, cells: int = CELLS, rows: int = ROWS, parts: int | None = None
) -> DataFrame:
    """One row per node: see the module's text. ``width``, ``cells`` and ``rows`` bound segments and shards."""
    need(conversations, "conv_id", "turn", "role", "text")
    spark = conversations.sparkSession
    prepare(spark)
    parts = parts or shuffle_parts(spark)
    segs = segments(conversations, width).withColumn("more", F.col("total") > (F.col("seg") + 1) * width)
    # Sorted, a conversation that goes on precedes those that end.
    end = F.when(F.col("more"), F.lit(bytearray(_GOES_ON))).otherwise(F.lit(bytearray(_ENDS)))
    path = F.concat(F.unhex(F.array_join("hashes", "")), end)
    segs = materialize(segs.withColumn("path", path).drop("hashes"), "segments")
    zero = F.lit(0).cast("long")
    weights = {c: zero for c in _SEGMENT if c.startswith("w_")}
    short = segs.filter(F.col("total") < width)
    short = short.withColumns({"key": F.lit(""), "next_key": F.lit(None).cast("string")} | weights)
    # Segments of long conversations: hashes of what is before and up to them, and what is below them.
    by_conv = Window.partitionBy("conv_id").orderBy("seg")
    until = by_conv.rowsBetween(Window.unboundedPreceding, 0)
    turns_only = F.expr(f"substring(path, 1, length(path) - {TURN})")
    one, two = F.xxhash64(turns_only, "seg"), F.xxhash64("seg", turns_only, F.lit("second"))
    up_to = F.concat_ws("-", F.col("seg") + 1, F.hex(F.bit_xor(one).over(until)), F.hex(F.bit_xor(two).over(until)))
    long = segs.filter(F.col("total") >= width)
    long = long.withColumn("next_key", up_to).withColumn("key", F.coalesce(F.lag("next_key").over(by_conv), F.lit("")))
    long = materialize(long, "long-segments")
    later = long.filter("seg > 0")
    if later.isEmpty():
        long = long.withColumns(weights)
    else:
        counted = _sharded(later.withColumns(weights), parts).mapInArrow(_work(width, True, cells, rows), _OUT)
        counted = _corrected(materialize(counted, "row-starts"), "row", width, True)
        counted = counted.groupBy("conv_id", "seg").agg(*(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "distinct_chars")))
        below = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
        own_chars = F.aggregate("chars", zero, lambda a, x: a + x)
        joined = long.join(counted, ["conv_id", "seg"], "left")
        summed = {"w_leaves": F.col("n_leaves"), "w_distinct": F.col("distinct_chars"), "w_member": own_chars}
        found = {k: F.coalesce(F.sum(v).over(below), zero) for k, v in summed.items()}
        found["w_children"] = F.coalesce(F.lead("n_children").over(by_conv), zero)
        long = joined.withColumns(found)
    full = short.select(*_SEGMENT).union(long.select(*_SEGMENT))
    made = materialize(_sharded(full, parts).mapInArrow(_work(width, False, cells, rows), _OUT), "shards")
    return _assembled(made, width)


def _assembled(made: DataFrame, width: int) -> DataFrame:
    counts = ["n_convs", "n_children", "n_leaves", "member_chars", "distinct_chars"]
    wide = _corrected(made, "open", width, False).groupBy("node_key").agg(
        *(F.min(c).alias(c) for c in ("conv_id", "depth", "parent_key", "parent_conv_id")), *(F.sum(c).alias(c) for c in counts)
    )
    pieces = made.filter("kind = 'piece'").select("node_key", "first_id", "ids")
    pieces = pieces.repartition("node_key").sortWithinPartitions("node_key", "first_id")
    hashed = pieces.mapInArrow(_hashes, "node_key string, hashed string")
    wide = wide.join(hashed, "node_key", "left").withColumn("ends", F.coalesce("hashed", F.lit(_NOTHING)))
    wide = materialize(wide, "open-nodes")
    columns = ["conv_id", "depth", "parent_key", "parent_conv_id", *counts, "ends"]
    nodes = made.filter("kind = 'node'").select(*columns).union(wide.select(*columns))
    parents = wide.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("above"))
    nodes = nodes.join(parents, "parent_key", "left")
    alone = (F.col("depth") == 0) & (F.col("n_children") == 0)
    return nodes.select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.when(alone, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("member_chars") - F.col("distinct_chars")).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
