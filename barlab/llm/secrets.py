"""Secrets in texts: fixed patterns, and strings that pass a battery of randomness tests.

A candidate is a run of characters of base64 with letters, and every part of such a run between
slashes, dashes and underscores, or pluses: a path, a prefix or a mixture of both base64 alphabets
does not hide a secret. Its encoding (hex, letters, base32, base36, base62 or base64) is the smallest
that holds all its characters. ``LEAST`` is the length from which a candidate is judged. Three tests
ask whether it could be uniformly random in that alphabet: chi-squared over character classes and
over single characters, runs above and below the alphabet's middle, and serial correlation. Fisher's
method combines them. Text-like strings fail.

How large a combined p-value a string needs is ``THIN``, unless its encoding and length class, counted
over all texts, shows otherwise: p-values of random strings are uniform, so those above one half
bound how many strings of a class are random. The cutoff rises only where even the bound leaves more
than ``false_share`` of what passes to other strings, and falls below ``THIN`` bin by bin while the
bin's own strings are random by that share. So a class of few strings loses none of them by chance.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.shared import need, prepare
from barlab.session import materialize

KINDS = ("assign", "access", "hex", "random")
FALSE_SHARE = 0.1
LENGTHS = (16, 20, 24, 32, 48, 96)
# Lower ends of the bins of p-values, the cutoff of classes that show nothing else, and how much more
# often than uniform p-values those of random strings are below it.
EDGES = (0.0, 0.0001, 0.001, 0.01, *(b / 20 for b in range(1, 20)))
BINS = len(EDGES)
THIN, HALF = EDGES.index(0.01), EDGES.index(0.5)
TAIL = 2.5

# The patterns and least lengths of the base scan.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGNED = 12

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_PARTS = [re.compile(p) for p in ("[^/]{16,}", "[^_-]{16,}", "[^/_-]{16,}", "[^/+]{16,}", "[^/+_-]{16,}")]
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Alphabets in order of size, each with its characters' classes.
ENCODINGS: list[tuple[str, list[str]]] = [
    ("hex", [_DIGITS, "abcdef"]),
    ("HEX", [_DIGITS, "ABCDEF"]),
    ("base32", [_UPPER, "234567"]),
    ("base36", [_LOWER, _DIGITS]),
    ("BASE36", [_UPPER, _DIGITS]),
    ("base62", [_LOWER, _UPPER, _DIGITS]),
    ("base64", [_LOWER, _UPPER, _DIGITS, "+/"]),
    ("base64url", [_LOWER, _UPPER, _DIGITS, "-_"]),
    ("lower", [_LOWER]),
    ("UPPER", [_UPPER]),
    ("letters", [_LOWER, _UPPER]),
]
# Where text-like strings can be told from random ones: of joined English words a third or less has p >= 0.01
# in base64 from 16, letters from 32 and letters of one case from 64 characters. Without digits: 32 or more.
LEAST = {"HEX": 16, "base64": 16, "lower": 64, "UPPER": 64, "letters": 32}
LEAST_USUAL, LEAST_UNDIGITED = 20, 32
_PLACES = [{c: i for i, c in enumerate("".join(classes))} for _, classes in ENCODINGS]
_BY_SIZE = sorted(range(len(ENCODINGS)), key=lambda e: len(_PLACES[e]))
_SETS = [frozenset(places) for places in _PLACES]
_LETTERS_ALONE = [e for e in _BY_SIZE if not _DIGIT.search("".join(ENCODINGS[e][1]))]


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_squared_tail(x: float, k: int, n: int) -> float:
    """Upper tail of a chi-squared statistic of n draws over k equal or grouped cells.

    Wilson and Hilferty's cube root, after scaling to the variance that n draws really give.
    """
    free = k - 1
    if free < 1:
        return 1.0
    x = free + (x - free) * math.sqrt(n / max(n - 1, 1))
    if x <= 0:
        return 1.0
    z = ((x / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    return _normal_tail(z)


def encoding_of(s: str) -> int | None:
    """Smallest alphabet that holds all characters (without padding), or None."""
    characters = set(s)
    for e in _BY_SIZE if _DIGIT.search(s) else [*_LETTERS_ALONE, *_BY_SIZE]:
        if characters <= _SETS[e]:
            return e
    return None


def randomness(s: str, e: int) -> float:
    """Combined p-value of the battery: small for strings that are not random in encoding e."""
    classes, places = ENCODINGS[e][1], _PLACES[e]
    n, k = len(s), len(places)
    x = [places[c] for c in s]
    counts = [0] * k
    for i in x:
        counts[i] += 1
    cells = sum(c * c for c in counts) * k / n - n
    grouped, start = 0.0, 0
    for group in classes:
        expected = n * len(group) / k
        grouped += (sum(counts[start : start + len(group)]) - expected) ** 2 / expected
        start += len(group)
    uniform = min(1.0, 2 * min(_chi_squared_tail(cells, k, n), _chi_squared_tail(grouped, len(classes), n)))
    # In the order of the alphabet mixed by a fixed stride, so that classes do not split at the middle.
    y = [i * 7 % k if k % 7 else i for i in x]
    high = [2 * i >= k for i in y]
    a = sum(high)
    b = n - a
    runs = 1 + sum(u != v for u, v in zip(high, high[1:]))
    if a and b and n > 2:
        mean = 2 * a * b / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        run_p = 2 * _normal_tail(abs(runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        run_p = 2.0 ** (1 - n)
    middle = sum(y) / n
    around = [i - middle for i in y]
    power = sum(v * v for v in around)
    serial = sum(u * v for u, v in zip(around, around[1:])) / power if power else 1.0
    serial_p = 2 * _normal_tail(abs(serial + 1 / n) * math.sqrt(n))
    half = -sum(math.log(max(min(p, 1.0), 1e-300)) for p in (uniform, run_p, serial_p))
    return math.exp(-half) * (1 + half + half * half / 2)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def parts(token: str) -> list[tuple[int, int]]:
    """(start, end) of a run and of its parts between separators, each once."""
    return sorted({(0, len(token)), *(m.span() for p in _PARTS for m in p.finditer(token))})


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, int, int]]:
    """(start, end, class, bin) of the strings outside the base spans that the battery judges."""
    out = []
    for m in _CANDIDATE.finditer(text):
        run = m[0].rstrip("=")
        near = [(s, e) for s, e, _ in base if s < m.end() and m.start() < e]
        for first, last in parts(run) if _LETTER.search(run) else ():
            token, start = run[first:last], m.start() + first
            end = m.end() if last == len(run) else m.start() + last
            if not _LETTER.search(token) or any(s < end and start < e for s, e in near):
                continue
            e = encoding_of(token)
            if e is None:
                continue
            least = LEAST.get(ENCODINGS[e][0], LEAST_USUAL)
            if len(token) < (least if _DIGIT.search(token) else max(least, LEAST_UNDIGITED)):
                continue
            size = sum(len(token) >= n for n in LENGTHS) - 1
            level = bisect_right(EDGES, randomness(token, e)) - 1
            out.append((start, end, e * len(LENGTHS) + size, level))
    return out


def cutoffs(counts: dict[tuple[int, int], int], false_share: float = FALSE_SHARE) -> dict[int, int]:
    """Class -> first bin that passes, from counts per (class, bin); every class has one.

    The number of random strings is bounded from those in the upper half (the upper 95 % limit of a
    Poisson mean).
    """
    out = {}
    for kind in {k for k, _ in counts}:
        n = [counts.get((kind, b), 0) for b in range(BINS)]
        upper = sum(n[HALF:])
        random = 2 * (upper + 1.6 + 1.645 * math.sqrt(upper + 0.7))
        first = THIN
        while first < HALF and (1 - false_share) * sum(n[first:]) > random * (1 - EDGES[first]):
            first += 1
        while 0 < first <= THIN:
            if (1 - false_share) * n[first - 1] > TAIL * random * (EDGES[first] - EDGES[first - 1]):
                break
            first -= 1
        out[kind] = first
    return out


def with_random(base, tested, passing: dict[int, int]) -> list[tuple[int, int, str]]:
    """The base spans and the candidates that pass, by start and then kind; those that overlap are one."""
    added = []
    for start, end, kind, level in sorted(tested):
        if level >= passing.get(kind, BINS):
            if added and start < added[-1][1]:
                added[-1] = (added[-1][0], max(end, added[-1][1]), "random")
            else:
                added.append((start, end, "random"))
    return sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2])))


def found_spans(text: str, passing: dict[int, int]) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    return with_random(base, candidates(text, base), passing)


_SCAN = "doc_id long, spans array<struct<start:int,end:int,kind:string>>, tested array<struct<start:int,end:int,class:int,bin:int>>"


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def _judge(passing: dict[int, int]):
    """Rows of ``_scan`` with their final spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [
                [
                    {"start": s, "end": e, "kind": k}
                    for s, e, k in with_random(
                        [(x["start"], x["end"], x["kind"]) for x in base],
                        [(x["start"], x["end"], x["class"], x["bin"]) for x in tested],
                        passing,
                    )
                ]
                for base, tested in zip(b.column(1).to_pylist(), b.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    return run


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    test = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("class", pa.int32()), ("bin", pa.int32())])
    )
    for b in batches:
        spans, tested = [], []
        for text in b.column(1).to_pylist():
            base = base_spans(text or "")
            spans.append([{"start": s, "end": e, "kind": k} for s, e, k in base])
            tested.append(
                [{"start": s, "end": e, "class": c, "bin": n} for s, e, c, n in candidates(text or "", base)]
            )
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(spans, _SPANS), pa.array(tested, test)], names=["doc_id", "spans", "tested"]
        )


def _class_counts(tested: DataFrame) -> dict[tuple[int, int], int]:
    """At most one count per encoding, length class and bin."""
    rows = tested.select(F.explode("tested").alias("t")).groupBy("t.class", "t.bin").count().collect()
    return {(r[0], r[1]): r[2] for r in rows}


def scan(
    docs: DataFrame, false_share: float = FALSE_SHARE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and spans (start, end in code points, kind) of every row, by start and then kind.

    NULL and empty texts have no spans. Ids may be NULL or repeated. Other columns are ignored; an
    empty table gives no rows.
    """
    need(docs, id_column, text_column)
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    found = materialize(rows.mapInArrow(_scan, _SCAN), "secrets")
    passing = cutoffs(_class_counts(found), false_share)
    return found.mapInArrow(_judge(passing), "doc_id long, spans array<struct<start:int,end:int,kind:string>>")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text, per row of ``scan``."""

    def joined(spans):
        text = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(text, ",")

    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return scanned.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count("random").alias("n_random"),
    )


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _redact(column: str, length: str | None, passing: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = list(b.columns)
            at = b.schema.get_field_index(column)
            old = columns[at].to_pylist()
            new = [t if t is None else redacted(t, found_spans(t, passing)) for t in old]
            columns[at] = pa.array(new, b.schema.field(at).type)
            if length is not None:
                k = b.schema.get_field_index(length)
                sizes = [v if s == t else len(t) for v, s, t in zip(columns[k].to_pylist(), old, new)]
                columns[k] = pa.array(sizes, b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return run


def redact(
    docs: DataFrame,
    false_share: float = FALSE_SHARE,
    id_column: str = "doc_id",
    text_column: str = "text",
    length_column: str | None = "n_chars",
) -> DataFrame:
    """All rows and columns of ``docs``; every secret in a text is replaced by its kind in brackets.

    The length column, if the table has it, follows the texts that change. Texts without a secret
    stay as they are. The texts are scanned twice: to count the classes, and to redact.
    """
    need(docs, id_column, text_column)
    prepare(docs.sparkSession)
    rows = docs.select(F.lit(0).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    tested = materialize(rows.mapInArrow(_scan, _SCAN).select("tested").filter(F.size("tested") > 0), "tested")
    passing = cutoffs(_class_counts(tested), false_share)
    length = length_column if length_column in docs.columns else None
    return docs.mapInArrow(_redact(text_column, length, passing), docs.schema)


