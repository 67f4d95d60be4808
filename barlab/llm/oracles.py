"""DuckDB SQL of the queries that SQL can state."""

from __future__ import annotations

import math

from barlab.llm import licenses
from barlab.llm.quality_rules import ERROR, MIN_WORDS, RISK, RULES

_SPACE = "[\\x20\\x09-\\x0D]+"
_VALUES = {
    "repeated_words": "coalesce(n_repeat_words / nullif(n_words, 0)::DOUBLE, 0)",
    "repeated_lines": "coalesce(n_dup_lines / nullif(n_lines, 0)::DOUBLE, 0)",
    "symbols": "coalesce(n_symbols / nullif(word_chars, 0)::DOUBLE, 0)",
    "long_words": "coalesce(word_chars / nullif(n_words, 0)::DOUBLE, 0)",
    "short_words": "-coalesce(word_chars / nullif(n_words, 0)::DOUBLE, 0)",
}


def _over(name: str) -> str:
    start, step, _ = RULES[name][1]
    return f"ceil(({_VALUES[name]} - {start!r}::DOUBLE) / {step!r}::DOUBLE)"


def quality_sql() -> str:
    """Metrics from unnested words and lines; binomial tails from logarithms of factorials."""
    p = RISK / len(RULES)
    levels = "\n  UNION ALL ".join(
        f"SELECT stratum, '{name}' AS rule, {count} AS cutoffs, least(greatest({_over(name)}, 0), {count}) AS level FROM good"
        for name, (_, (_, _, count)) in RULES.items()
    )
    rejected = " OR ".join(
        f"coalesce({_over(name)} > (SELECT j FROM chosen c WHERE c.rule = '{name}' AND c.stratum = m.stratum), FALSE)"
        for name in RULES
    )
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT row, list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols
  FROM docs
), windows AS (
  SELECT row, i, w[i:i + 2] AS win FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM parts)
), again AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY row
), m AS (
  SELECT d.doc_id, d.stratum, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines,
    len(w) < {MIN_WORDS} OR 100 * coalesce(c.n, 0) > 50 * len(w) AS base_failed
  FROM docs d JOIN parts p USING (row) LEFT JOIN covered c USING (row)
), good AS (
  SELECT m.* FROM m JOIN (SELECT doc_id, min(quality) AS q FROM labels GROUP BY doc_id) USING (doc_id)
  WHERE q = 1 AND NOT base_failed
), levels AS (
  {levels}
), tests AS (
  SELECT stratum, rule, j, count(*) AS n, count(*) FILTER (WHERE level > j) AS x
  FROM (SELECT *, unnest(range(0, cutoffs)) AS j FROM levels) GROUP BY ALL
), tails AS (
  SELECT *, CASE WHEN x > n * {p!r}::DOUBLE THEN 1 ELSE list_sum(list_transform(range(0, x + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * {math.log(p)!r}::DOUBLE
        + (n - i) * {math.log1p(-p)!r}::DOUBLE))) END AS tail,
    (SELECT count(*) FROM (SELECT DISTINCT stratum, rule FROM levels)) AS number
  FROM tests
), valid AS (
  SELECT *, bool_and(tail <= {ERROR!r}::DOUBLE / number) OVER (PARTITION BY stratum, rule ORDER BY j DESC) AS passed FROM tails
), chosen AS (
  SELECT stratum, rule, min(j) AS j FROM valid WHERE passed GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({rejected}) AS kept
FROM m
"""


# A-Z alone is lowered; DuckDB's lower() would change letters beyond ASCII too.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
# The unsigned CRC-32 of a number's decimal text, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
    lambda x: unicode(x)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)"""


def trie_sql() -> str:
    """Every prefix of every rebuilt conversation as a list, grouped; subtrees by all prefixes of every node."""
    return f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS s FROM turns GROUP BY conv_id
), cuts AS (
  SELECT *, {_CRC} % 6 AS h, conv_id - conv_id % 100 AS base_id FROM own
), seqs AS (
  SELECT c.conv_id, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) AS s
  FROM cuts c LEFT JOIN own b ON b.conv_id = c.base_id
), prefixes AS (
  SELECT conv_id, s, d, s[1:d] AS p FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM seqs)
), nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '') AS ends
  FROM prefixes GROUP BY p, d
), children AS (
  SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), valued AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
    CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(p[d].text) END AS saved
  FROM nodes n LEFT JOIN children c USING (p, d)
), subtrees AS (
  SELECT p[1:k] AS p, k AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM valued) GROUP BY ALL
)
SELECT v.conv_id, v.d::BIGINT AS depth, up.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
  v.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN subtrees s USING (p, d) LEFT JOIN nodes up ON v.d > 0 AND up.d = v.d - 1 AND up.p = v.p[1:v.d - 1]
"""


def ranking_sql() -> str:
    """All scores of every item and document that share a term."""
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents
), sized AS (
  SELECT row, doc_id, t, len(t)::BIGINT AS n FROM docs WHERE len(t) > 0
), totals AS (
  SELECT count(*)::BIGINT AS many, sum(n)::BIGINT AS terms FROM sized
), tf AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(t) AS term FROM sized) GROUP BY ALL
), items AS (
  SELECT row_number() OVER () AS item, item_id, {_TERMS} AS t FROM benchmark
), wanted AS (
  SELECT item, item_id, term, count(*)::BIGINT AS qtf FROM (SELECT item, item_id, unnest(t) AS term FROM items) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * many + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, totals WHERE term IN (SELECT term FROM wanted) GROUP BY term, many
), scored AS (
  SELECT item, item_id, row, doc_id,
    sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * many) // terms))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN sized USING (row), totals
  GROUP BY item, item_id, row, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
) WHERE rank <= 20
"""


def licenses_sql() -> str:
    """Places of the phrases word by word; every block against every template."""
    places = []
    for phrase, label in licenses.PHRASES.items():
        words = phrase.split()
        same = " AND ".join(f"t[i + {k}] = '{w}'" for k, w in enumerate(words))
        places.append(f"SELECT row, i - 1 AS place, '{label}' AS label FROM word_at WHERE {same}")
    rows = []
    for label, text in licenses.TEMPLATES:
        quoted = text.replace("'", "''")
        rows.append(f"('{label}', '{quoted}')")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents
), word_at AS (
  SELECT row, t, unnest(range(1, len(t) + 1)) AS i FROM docs
), places AS (
  {" UNION ALL ".join(places)}
), base AS (
  SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY row
), templates AS (
  SELECT label, list_distinct(t) AS own, greatest(1, (len(list_distinct(t)) * {licenses.PERCENT} + 99) // 100) AS need,
    (2 ** ceil(log2(len(t))))::BIGINT AS width
  FROM (SELECT label, {_TERMS} AS t FROM (VALUES {", ".join(rows)}) v(label, text))
), widths AS (
  SELECT DISTINCT width FROM templates
), blocks AS (
  SELECT row, width, list_distinct(t[b * width + 1:(b + 2) * width]) AS words
  FROM (SELECT row, t, width, unnest(range(0, (len(t) + width - 1) // width)) AS b FROM docs, widths)
), found AS (
  SELECT row, label, max(len(list_intersect(words, own)) / len(own)::DOUBLE) AS share
  FROM blocks JOIN templates USING (width) WHERE len(list_intersect(words, own)) >= need GROUP BY row, label
), own AS (
  SELECT row, list(DISTINCT label) AS labels, max(share) AS share FROM found GROUP BY row
)
SELECT doc_id, len(t)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(o.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(o.share, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN base b USING (row) LEFT JOIN own o USING (row)
"""
