"""N-gram Jaccard join: near copies by exact Jaccard similarity of word shingles.

Every text is its set of n-word shingles, each a 64-bit token, kept in one global order: rare
shingles first. Two sets with similarity ``percent`` share a token among the first
``n - ceil(percent * n) + 1`` of each, so only documents that meet in such a prefix are compared.
Two prefixes longer by ``COMMON - 1`` tokens share ``COMMON`` of them, so that a chance token alone makes no pair.
Any order is exact; this one puts the most frequent shingles (counted over all blocks, at most
``FREQUENT``) last and otherwise long shingles before short ones, as long word sequences repeat
least.

1. ``profiles``: one pass over the texts gives set size, set signature and ordered prefix.
2. Equal sets are one class with its smallest id as representative; only these go on.
3. Documents of a token group are first compared with the ``WINDOW`` documents before them by
   size, and each is verified with the closest of these only; then once more with the closest of
   another component. So a large group of near copies falls into few components by work that is
   linear in its size.
4. Then every pair of a token group that is not yet in one component is tested inside its task and
   leaves it only if it may reach the similarity: by size, by the places of the token (a pair's
   first common tokens lie early in both sets), and by bitmaps in which every token of a set flips
   one of ``BITS`` bits, so that two bitmaps never differ in more bits than the sets in tokens. Pairs
   go on that are left by ``COMMON`` tokens, or by as many as their intersection needs.
5. ``verify``: pairs whose bitmaps of full width still leave the similarity possible are verified, and only
   their sets are made; the partners of a document are stored as ordered sets in a trie (sorted,
   so that neighbours share their path). Its traversal takes over the partial overlap of the shared
   path and leaves a subtree once the remaining lengths cannot reach the required overlap.

6. ``all_links``: the distinct sets of a component, which holds all their links, are dealt to cells of
   ``CELL`` sets by size band; every two cells whose sizes allow a link meet once as a block, with each
   set once, and the trie of one cell is walked for each set of the other. A block returns its links,
   or their number per set.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm import texts
from barlab.llm.components import components
from barlab.llm.shared import BROADCAST_KEYS, keep_ids, need, prepare, shuffle_parts, without_ids
from barlab.session import materialize

# Shingles known to be frequent and put last in the order (8 bytes each are broadcast).
FREQUENT = 65_536
# A shingle is reported by a block of this many documents if it holds it so often.
BLOCK_REPEATS = 8
BLOCK_BYTES = 16 << 20
# Bits of a set's bitmap, 64 bytes that go with each shared prefix token.
BITS = 512
# Documents before it, by size, that a document is first compared with.
WINDOW = 32
# Partners of one document that are verified in one group.
PARTNERS = 1024
# Tokens that two prefixes must share; these are longer by one less.
COMMON = 3
# Sets of one cell; two cells meet in one task.
CELL = 256

_LATE = np.uint64(1 << 62)


def _tokens(data: np.ndarray, offsets: np.ndarray, n: int, lower: bool):
    """Shingle tokens below 2^62, long shingles first, with the documents' bounds."""
    hashes, lengths, bounds = texts.shingle_hashes(texts.lowered(data) if lower else data, offsets, n)
    short = np.uint64(63) - np.minimum(lengths >> 1, 63).astype(np.uint64)
    return (short << np.uint64(56)) | (hashes >> np.uint64(8)), bounds


def _frequent(n: int, lower: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def report():
            if held:
                token, times = np.unique(np.concatenate(held), return_counts=True)
                often = times >= BLOCK_REPEATS
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[often].astype(np.int64)), pa.array(times[often])], names=["token", "n"]
                )

        for b in batches:
            for _, data, offsets in texts.slices(b.column(0)):
                held.append(_tokens(data, offsets, n, lower)[0])
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield from report()
                    held, size = [], 0
        yield from report()

    return count


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + COMMON) if n else 0


def _ordered_sets(column: pa.Array, n: int, lower: bool, frequent: np.ndarray) -> Iterator[np.ndarray]:
    """The ordered token set of every text."""
    for _, data, offsets in texts.slices(column):
        tokens, bounds = _tokens(data, offsets, n, lower)
        if len(frequent) and len(tokens):
            at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
            tokens = np.where(frequent[at] == tokens, tokens | _LATE, tokens)
        for i in range(len(bounds) - 1):
            yield np.unique(tokens[bounds[i] : bounds[i + 1]])


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Every token flips one bit."""
    odd = np.bincount((tokens % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _profiles(n: int, lower: bool, percent: int, frequent: np.ndarray):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, signatures, prefixes, maps, wide = [], [], [], [], []
            for tokens in _ordered_sets(b.column(1), n, lower, frequent):
                sizes.append(len(tokens))
                signatures.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                prefixes.append(tokens[: prefix_length(len(tokens), percent)].astype(np.int64))
                maps.append(bitmap(tokens).tobytes())
                wide.append(wide_bitmap(tokens).tobytes() if 2 * len(tokens) > BITS else None)
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                    pa.array(maps, pa.binary()),
                    pa.array(wide, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "signature", "prefix", "bitmap", "wide"],
            )

    return profile


def wide_bitmap(tokens: np.ndarray) -> np.ndarray:
    """A bitmap with two bits per token or more, a power of two in all."""
    bits = max(BITS, 1 << (2 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """Bits in which two wide bitmaps differ; the wider one is folded onto the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum(dtype=np.int64))


def _sets(n: int, lower: bool, frequent: np.ndarray):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.astype(">u8").tobytes() for s in _ordered_sets(b.column(1), n, lower, frequent)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["doc_id", "tokens"])

    return make


def _close_enough(percent: int):
    """The pairs (a, b, n_a, n_b, bitmap_a, bitmap_b) whose wide bitmaps leave the similarity possible."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_a, n_b = b.column(2).to_numpy(), b.column(3).to_numpy()
            most = n_a + n_b - 2 * required_overlap(n_a, n_b, percent)
            maps = zip(b.column(4).to_pylist(), b.column(5).to_pylist())
            use = [
                apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= m for (x, y), m in zip(maps, most)
            ]
            use = pa.array(use, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(use), b.column(1).filter(use)], names=["a", "b"])

    return keep


def required_overlap(n_a, n_b, percent: int):
    """Smallest intersection with 100 * intersection >= percent * union."""
    return -(-percent * (n_a + n_b) // (100 + percent))


class _Rows:
    """Rows (token, n, doc, place, component, bitmap) sorted by token and size."""

    def __init__(self, batch: pa.RecordBatch, before: _Rows | None = None, keep: slice = slice(0)):
        columns = [batch.column(i).to_numpy() for i in range(5)]
        maps = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64).reshape(-1, BITS // 64)
        if before is not None:
            columns = [np.concatenate((x[keep], y)) for x, y in zip(before.columns, columns)]
            maps = np.concatenate((before.maps[keep], maps))
        self.columns, self.maps = columns, maps
        self.token, self.n, self.doc, self.place, self.component = columns

    def able(self, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Which rows j, no shorter than rows i, can be their partners with this among the first
        ``COMMON`` common tokens, and in how many bits these differ."""
        n_i, n_j = self.n[i], self.n[j]
        least = required_overlap(n_i, n_j, percent)
        use = (self.component[i] != self.component[j]) & (n_i >= least)
        use &= (self.place[i] < n_i - least + COMMON) & (self.place[j] < n_j - least + COMMON)
        at = np.flatnonzero(use)
        apart = np.bitwise_count(self.maps[i[at]] ^ self.maps[j[at]]).sum(axis=1, dtype=np.int64)
        near = apart <= n_i[at] + n_j[at] - 2 * least[at]
        return at[near], apart[near]


def _counted_pairs(a: np.ndarray, b: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
    """Pairs of different documents, the smaller id first, how often each came and the least ``wanted``."""
    both = np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1)
    other = both[:, 0] != both[:, 1]
    both, at, times = np.unique(both[other], axis=0, return_inverse=True, return_counts=True)
    least = np.full(len(both), COMMON)
    np.minimum.at(least, at.reshape(-1), wanted[other])
    columns = [*both.T, times, least]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], names=["a", "b", "times", "wanted"]
    )


def _closest(percent: int):
    """For each row, the closest of the rows just before it that may be a link (a, b, apart)."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keep = None, slice(0)
        for b in batches:
            if not b.num_rows:
                continue
            rows = _Rows(b, rows, keep)
            j = np.arange(len(rows.token) - b.num_rows, len(rows.token))
            best = np.full(len(rows.token), BITS + 1)
            partner = np.full(len(rows.token), -1)
            for back in range(1, WINDOW + 1):
                j = j[j >= back]
                i = j - back
                near = (rows.token[i] == rows.token[j]) & (100 * rows.n[i] >= percent * rows.n[j])
                i, j = i[near], j[near]
                if not len(j):
                    break
                at, apart = rows.able(i, j, percent)
                closer = apart < best[j[at]]
                at, apart = at[closer], apart[closer]
                best[j[at]], partner[j[at]] = apart, i[at]
            found = np.flatnonzero(partner >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows.doc[found]), pa.array(rows.doc[partner[found]]), pa.array(best[found])],
                names=["a", "b", "apart"],
            )
            keep = slice(max(0, len(rows.token) - WINDOW), None)

    return pair


def _across(percent: int):
    """Pairs of a token whose components differ, as far as they may be links, with their number of tokens.

    Row j is tested against the row one before it, then two, and so on, for all j at once; a j
    drops out where the token or the sizes' ratio ends.
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keep, held, size = None, slice(0), [], 0
        for b in batches:
            if not b.num_rows:
                continue
            rows = _Rows(b, rows, keep)
            j, back = np.arange(len(rows.token) - b.num_rows, len(rows.token)), 0
            while len(j):
                back += 1
                j = j[j >= back]
                i = j - back
                near = (rows.token[i] == rows.token[j]) & (100 * rows.n[i] >= percent * rows.n[j])
                i, j = i[near], j[near]
                ok, _ = rows.able(i, j, percent)
                if len(ok):
                    x, y = i[ok], j[ok]
                    wanted = np.minimum(required_overlap(rows.n[x], rows.n[y], percent), COMMON)
                    held.append((rows.doc[x], rows.doc[y], wanted))
                    size += len(ok)
                if size >= 1 << 19:
                    yield _counted_pairs(*(np.concatenate(x) for x in zip(*held)))
                    held, size = [], 0
            # Of the last token, rows that are long enough to meet later ones.
            first = np.searchsorted(rows.token, rows.token[-1])
            first += np.searchsorted(100 * rows.n[first:], percent * rows.n[-1])
            keep = slice(int(first), None)
        if held:
            yield _counted_pairs(*(np.concatenate(x) for x in zip(*held)))

    return pair


def trie_links(query: np.ndarray, sets: list[bytes], percent: int) -> list[int]:
    """Indices of the sets (sorted tokens, big-endian) whose similarity with the query suffices.

    The sets are walked in lexicographic order, which is a depth-first walk of their trie.
    ``overlap[d]`` is the overlap of the current path's first d tokens; the next set goes on from
    where its path leaves the current one.
    """
    found, n_q = [], len(query)
    path, overlap = np.zeros(0, np.uint64), np.zeros(1, np.int64)
    for i in sorted(range(len(sets)), key=sets.__getitem__):
        tokens = np.frombuffer(sets[i], ">u8").astype(np.uint64)
        n = len(tokens)
        if not n or not n_q:
            continue
        least = required_overlap(n_q, n, percent)
        reach = min(len(overlap) - 1, n)
        differ = np.flatnonzero(tokens[:reach] != path[:reach])
        depth = int(differ[0]) if len(differ) else reach
        counts = [overlap[: depth + 1]]
        total, step = int(overlap[depth]), 64
        while depth < n:
            passed = int(np.searchsorted(query, tokens[depth - 1], "right")) if depth else 0
            if total + min(n_q - passed, n - depth) < least:
                break
            part = tokens[depth : depth + step]
            at = np.minimum(np.searchsorted(query, part), n_q - 1)
            run = total + np.cumsum(query[at] == part)
            counts.append(run)
            total, depth, step = int(run[-1]), depth + len(part), step * 2
        if depth == n and total >= least:
            found.append(i)
        path, overlap = tokens, np.concatenate(counts)
    return found


def _verify(percent: int):
    """Rows sorted by (a, salt, query first): a document's own set, then its partners' sets."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, queries, partners, sets = None, [], [], []

        def links():
            got = sorted({partners[i] for q in queries for i in trie_links(q, sets, percent)})
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]] * len(got), pa.int64()), pa.array(got, pa.int64())], names=["a", "b"]
                )

        for b in batches:
            for a, salt, partner, tokens in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (a, salt) != key:
                    yield from links()
                    key, queries, partners, sets = (a, salt), [], [], []
                if partner is None:
                    queries.append(np.frombuffer(tokens, ">u8").astype(np.uint64))
                else:
                    partners.append(partner)
                    sets.append(tokens)
        yield from links()

    return verify


def _signed_sets(n: int, lower: bool, frequent: np.ndarray):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            signatures, sets = [], []
            for s in _ordered_sets(b.column(1), n, lower, frequent):
                signatures.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sets.append(s.astype(">u8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(signatures, pa.binary()), pa.array(sets, pa.binary())],
                names=["rep", "signature", "tokens"],
            )

    return make


def _block_links(percent: int, count: bool):
    """Rows (block, second, one, rep, signature, tokens) sorted by block: all links between its two cells.

    ``second`` tells the cells apart; with ``one``, the block is a cell with itself. Returns the links (a, b,
    signature_a, signature_b), each once, or (signature, links) per set.
    """

    def links(sides, one):
        """Sets of the first cell and what they are linked with; a set that came twice counts once."""
        queries, partners = (sorted(side.items()) for side in (sides[0], sides[0] if one else sides[1]))
        partners.sort(key=lambda x: x[1][1])
        sets = [tokens for _, (_, tokens) in partners]
        for signature, (doc, tokens) in queries:
            for i in trie_links(np.frombuffer(tokens, ">u8").astype(np.uint64), sets, percent):
                other, (partner, _) = partners[i]
                if not one or signature < other:
                    yield doc, partner, signature, other

    def batch(found):
        if count:
            times = Counter(x for link in found for x in link[2:])
            columns = [pa.array(list(times), pa.binary()), pa.array(list(times.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["signature", "n_links"])
        a, b, x, y = zip(*found) if found else ((), (), (), ())
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "signature_a", "signature_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, alone, sides = None, False, ({}, {})
        for b in batches:
            for block, second, one, doc, signature, tokens in zip(*(b.column(i).to_pylist() for i in range(6))):
                if block != key:
                    yield batch(list(links(sides, alone)))
                    key, alone, sides = block, one, ({}, {})
                sides[second][signature] = (doc, tokens)
        yield batch(list(links(sides, alone)))

    return run


class NgramJoin:
    """The join of one table of texts. ``percent`` is the least Jaccard similarity in percent."""

    def __init__(self, docs: DataFrame, id_column: str, text_column: str, percent: int, n: int, lower: bool):
        need(docs, id_column, text_column)
        prepare(docs.sparkSession)
        self.percent, self.n, self.lower = percent, n, lower
        self.docs = docs.select(
            F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
        )
        self.parts = shuffle_parts(docs.sparkSession)
        self.frequent = self._frequent_tokens()
        made = self.docs.mapInArrow(
            _profiles(n, lower, percent, self.frequent),
            "doc_id long, n_shingles long, signature binary, prefix array<long>, bitmap binary, wide binary",
        )
        self.profiles = materialize(made, "profiles")

    def _frequent_tokens(self) -> np.ndarray:
        counts = self.docs.select("text").mapInArrow(_frequent(self.n, self.lower), "token long, n long")
        top = (
            counts.groupBy("token")
            .agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "token")
            .limit(FREQUENT)
            .select("token")
        )
        return np.sort(np.array([r[0] for r in top.collect()], np.int64)).astype(np.uint64)

    def classes(self) -> DataFrame:
        """(n_shingles, signature, rep): one row per distinct set that is not empty."""
        kept = self.profiles.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        return kept.groupBy("n_shingles", "signature").agg(F.min("doc_id").alias("rep"))

    def representatives(self) -> DataFrame:
        """The profiles whose id is the smallest of their set. The others are found by id and signature
        and broadcast behind a count, so that the prefixes need no shuffle; beyond it the join shuffles."""
        kept = self.profiles.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        several = kept.groupBy("n_shingles", "signature")
        several = several.agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).filter("rep < last")
        copies = kept.select("doc_id", "n_shingles", "signature").join(several, ["n_shingles", "signature"])
        copies = copies.filter("doc_id <> rep").select("doc_id", "signature").distinct()
        return kept.join(self._few(materialize(copies, "copies")), ["doc_id", "signature"], "left_anti")

    @staticmethod
    def _few(rows: DataFrame) -> DataFrame:
        """Stored rows of several columns, marked for broadcast if there are few."""
        return F.broadcast(rows) if rows.count() <= BROADCAST_KEYS // 4 else rows

    def _by_token(self, shared: DataFrame, documents: DataFrame) -> DataFrame:
        rows = shared.join(documents, "doc_id").select("token", "n", "doc_id", "place", "component", "bitmap")
        return rows.repartition(self.parts, "token").sortWithinPartitions("token", "n", "doc_id")

    def _meetings(self, postings: DataFrame) -> DataFrame:
        """The (token, n, place, doc_id) that may link a document, with its ``partner`` for a token of two.

        Most prefix tokens are in one document only, or in documents of sizes too far apart, or come too late in
        them. In the shorter set of a link the token comes as early as a link with a set of its own size asks for; of the
        shorter fellows for which it does, the longest is the nearest in size, of the longer ones the shortest. Two
        fellows have one row, if the size and the token's places allow their link, with the number of tokens ``wanted``.
        """
        group = Window.partitionBy("token")
        by_size = group.orderBy("n", "doc_id")
        least = lambda x, y: f"(({self.percent} * ({x} + {y}) + {99 + self.percent}) div {100 + self.percent})"
        # Dealt out first, so that only the postings themselves are shuffled.
        rows = postings.repartition("token").withColumn("early", F.expr(f"place < n - {least('n', 'n')} + {COMMON}"))
        around = {f"shorter_{c}": F.lag(c).over(by_size) for c in ("n", "place", "doc_id")} | {
            "shorter": F.last(F.when(F.col("early"), F.col("n")), ignorenulls=True).over(
                by_size.rowsBetween(Window.unboundedPreceding, -1)
            ),
            "longer": F.lead("n").over(by_size),
            "holders": F.count(F.lit(1)).over(group),
        }
        both = least("n", "shorter_n")
        two = f"shorter_place < shorter_n - {both} + {COMMON} AND place < n - {both} + {COMMON} AND shorter_doc_id <> doc_id"
        two = f"{two} AND 100 * shorter_n >= {self.percent} * n"
        many = f"100 * shorter >= {self.percent} * n OR (early AND 100 * n >= {self.percent} * longer)"
        rows = rows.withColumns(around).filter(f"(holders = 2 AND {two}) OR (holders > 2 AND ({many}))")
        partner = F.when(F.col("holders") == 2, F.col("shorter_doc_id")).alias("partner")
        wanted = F.when(F.col("holders") == 2, F.expr(f"least({COMMON}, {both})")).alias("wanted")
        return rows.select("token", "n", "place", "doc_id", partner, wanted)

    @staticmethod
    def _ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()

    def _possible(self, pairs: DataFrame, maps: DataFrame) -> DataFrame:
        """The (a, b) whose bitmaps, of (doc_id, n, bitmap) rows, leave the similarity possible."""
        side = lambda k: maps.select(
            F.col("doc_id").alias(k), F.col("n").alias(f"n_{k}"), F.col("bitmap").alias(f"bitmap_{k}")
        )
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        both = both.select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b")
        return both.mapInArrow(_close_enough(self.percent), "a long, b long").distinct()

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) whose full sets reach the similarity."""
        # Wide bitmaps are a 32nd of the sets; sets are made and stored only for pairs that these leave open.
        maps = self.profiles.select(
            "doc_id", F.col("n_shingles").alias("n"), F.coalesce("wide", "bitmap").alias("bitmap")
        )
        maps = keep_ids(maps, "doc_id", materialize(self._ends(pairs), "candidates"))
        pairs = materialize(self._possible(pairs, maps), "close")
        docs = keep_ids(self.docs, "doc_id", materialize(self._ends(pairs), "open"))
        make = _sets(self.n, self.lower, self.frequent)
        sets = materialize(docs.mapInArrow(make, "doc_id long, tokens binary"), "sets")
        sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        sizes = sizes.withColumn("salts", F.ceil(F.col("n") / PARTNERS).cast("int"))
        own = sizes.join(sets.withColumnRenamed("doc_id", "a"), "a").select(
            "a",
            F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
            F.lit(None).cast("long").alias("b"),
            "tokens",
        )
        partners = (
            pairs.join(sizes, "a")
            .join(sets.withColumnRenamed("doc_id", "b"), "b")
            .select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b", "tokens")
        )
        together = own.union(partners).repartition(self.parts, "a", "salt")
        together = together.sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        return together.mapInArrow(_verify(self.percent), "a long, b long")

    @staticmethod
    def _counted(pairs: DataFrame) -> DataFrame:
        """Each pair once, with all its common tokens; of an id with several texts the least number wanted."""
        return pairs.groupBy("a", "b").agg(F.sum("times").alias("times"), F.min("wanted").alias("wanted"))

    def links(self) -> DataFrame:
        """Links (a, b) between representatives that hold all components together."""
        reps = self.representatives()
        postings = reps.select(
            F.posexplode("prefix").alias("place", "token"), F.col("n_shingles").alias("n"), "doc_id"
        )
        shared = materialize(self._meetings(postings), "shared")
        # A token of two documents is one pair, which needs no group.
        twos = shared.filter("partner IS NOT NULL")
        twos = twos.select(
            F.least("doc_id", "partner").alias("a"), F.greatest("doc_id", "partner").alias("b"), F.lit(1).alias("times"), "wanted"
        )
        twos = materialize(self._counted(twos), "twos")
        shared = shared.filter("partner IS NULL").drop("partner", "wanted")
        found, labelled = None, reps.select("doc_id", "bitmap", F.col("doc_id").alias("component"))
        for exhaustive in (False, False, True):
            rows = self._by_token(shared, labelled)
            if exhaustive:
                across = rows.mapInArrow(_across(self.percent), "a long, b long, times long, wanted long")
                pairs = self._counted(across.union(twos.filter("times < wanted")))
                pairs = pairs.filter("times >= wanted").select("a", "b")
            else:
                near = rows.mapInArrow(_closest(self.percent), "a long, b long, apart long").filter("a <> b")
                near = near.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("m"))
                pairs = near.select("a", "m.b")
            if found is None:
                pairs = pairs.union(twos.filter("times >= wanted").select("a", "b"))
            links = self.verify(materialize(pairs, "pairs"))
            found = materialize(links if found is None else found.union(links), "links")
            if not exhaustive:
                known = components(found).withColumnRenamed("node", "doc_id")
                labelled = reps.select("doc_id", "bitmap").join(known, "doc_id", "left")
                labelled = labelled.withColumn("component", F.coalesce("component", "doc_id"))
        return found

    def _classes_joined(self) -> DataFrame:
        """n_shingles, signature, rep and component of every distinct set that is not empty."""
        joined = components(self.links())
        classes = self.classes().join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        return classes.select("n_shingles", "signature", "rep", F.coalesce("component", "rep").alias("component"))

    def _blocks(self, classes: DataFrame, count: bool, schema: str) -> DataFrame:
        # A link needs sizes in one band or in neighbouring ones.
        step = max(math.log(100 / self.percent), 1e-9) * (1 + 1e-9)
        placed = classes.withColumn("band", F.floor(F.log("n_shingles") / step))
        held = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("component")
        placed = placed.join(held, "component", "left_semi")
        bands = placed.groupBy("component", "band").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells"))
        bands = materialize(bands, "bands")
        cells = bands.withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        cells = cells.withColumn("at", F.struct("band", "cell")).select("component", "at", "band")
        other = cells.select("component", F.col("at").alias("at2"), F.col("band").alias("band2"))
        blocks = cells.join(other, "component").filter("at <= at2 AND band2 - band <= 1")
        blocks = blocks.withColumn("block", F.struct("component", "at", "at2")).withColumn("one", F.expr("at = at2"))
        blocks = blocks.select(
            "component",
            "block",
            "one",
            F.explode(
                F.when(F.col("one"), F.array(F.struct(F.lit(0).alias("second"), "at"))).otherwise(
                    F.array(
                        F.struct(F.lit(0).alias("second"), "at"), F.struct(F.lit(1).alias("second"), F.col("at2").alias("at"))
                    )
                )
            ).alias("side"),
        ).select("component", "block", "one", "side.second", F.col("side.at.band").alias("band"), F.col("side.at.cell").alias("cell"))
        cell = F.pmod(F.xxhash64("signature"), F.col("cells")).cast("int").alias("cell")
        members = placed.join(bands, ["component", "band"]).select("component", "band", cell, "rep", "signature")
        members = materialize(members, "members")
        made = keep_ids(self.docs, "doc_id", materialize(members.select(F.col("rep").alias("doc_id")).distinct(), "linked"))
        sets = made.mapInArrow(
            _signed_sets(self.n, self.lower, self.frequent), "rep long, signature binary, tokens binary"
        )
        # Blocks are found without the sets, which then go straight to their blocks.
        places = members.join(blocks, ["component", "band", "cell"])
        places = materialize(places.select("rep", "signature", "block", "second", "one"), "places")
        rows = sets.join(self._few(places), ["rep", "signature"])
        rows = rows.select(F.to_json("block").alias("block"), "second", "one", "rep", "signature", "tokens")
        rows = rows.repartition(self.parts, "block").sortWithinPartitions("block")
        return rows.mapInArrow(_block_links(self.percent, count), schema)

    def all_links(self) -> DataFrame:
        """Every link between different sets once: a, b (their representatives) and the signatures of both."""
        classes = materialize(self._classes_joined(), "classes")
        schema = "a long, b long, signature_a binary, signature_b binary"
        return self._blocks(classes, False, schema)

    def membership(self, count_links: bool = False) -> DataFrame:
        """doc_id, n_shingles, class_id and component_id of every row.

        A row without words has itself as class and component; a row without id has neither. With
        ``count_links`` also n_links, the number of other sets that the row's set is linked with.
        """
        classes = self._classes_joined()
        more = []
        if count_links:
            classes = materialize(classes, "classes")
            counts = self._blocks(classes, True, "signature binary, n_links long")
            counts = counts.groupBy("signature").agg(F.sum("n_links").alias("n_links"))
            classes = classes.join(counts, "signature", "left")
            more = [F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links")]
        # An id that several texts carry joins what any of them is linked with.
        rows = self.profiles.select("doc_id", "n_shingles", "signature").join(
            classes, ["n_shingles", "signature"], "left"
        )
        some = F.col("doc_id").isNotNull()
        return rows.select(
            "doc_id",
            "n_shingles",
            F.when(some, F.coalesce("rep", "doc_id")).alias("class_id"),
            F.when(some, F.coalesce("component", "doc_id")).alias("component_id"),
            *more,
        )


def ngram_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = 90,
    n: int = 3,
    lower: bool = True,
    count_links: bool = False,
) -> DataFrame:
    """Near-copy components of a table of texts: doc_id, n_shingles, class_id, component_id per row.

    With ``count_links`` also n_links, the number of other distinct sets that the row's set is linked with.

    NULL and empty texts have an empty set and are linked with nothing. Rows with one id are one
    document as far as components go only if their texts are linked. An empty table gives no rows;
    other columns are ignored.
    """
    return NgramJoin(docs, id_column, text_column, percent, n, lower).membership(count_links)


def ngram_links(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = 90,
    n: int = 3,
    lower: bool = True,
) -> DataFrame:
    """All links (a, b) between different sets of a table of texts, each once, by the smallest id of each set."""
    return NgramJoin(docs, id_column, text_column, percent, n, lower).all_links().select("a", "b")


def keep_one(
    docs: DataFrame,
    percent: int = 80,
    n: int = 5,
    lower: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows and columns of ``docs`` with one document of each component, the one with the smallest id.

    Rows without words or without id stay. Of rows equal in id and text one stays. Ids to drop are
    broadcast behind a count; beyond it the join shuffles.
    """
    members = ngram_components(docs, id_column, text_column, percent, n, lower)
    members = materialize(members.filter(F.col("doc_id").isNotNull()), "members")
    ids = members.groupBy("doc_id").agg(
        F.max(F.col("component_id") == F.col("doc_id")).alias("stays"), F.count(F.lit(1)).alias("rows")
    )
    gone = materialize(ids.filter(~F.col("stays")).select("doc_id"), "copies")
    kept = without_ids(docs, id_column, gone)
    repeated = materialize(ids.filter((F.col("rows") > 1) & F.col("stays")).select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    once = keep_ids(kept, id_column, repeated).dropDuplicates([id_column, text_column])
    return without_ids(kept, id_column, repeated).union(once.select(*kept.columns))
