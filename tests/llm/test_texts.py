"""Rules, mixing, secrets and the trained scorers."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barlab.llm import importance, language_id, mixing, quality_rules, secrets, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# --- quality rules ------------------------------------------------------------------------


def brute_metrics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(repeated)


def test_metrics_equal_brute_force(spark, docs_of, odd_rows):
    rows = odd_rows + [
        (30, "a b c a b c a b c x", "en", "s"),
        (31, "line one\nline one\n\nline one \n#*|<>\n", "en", "s"),
        (32, "a a a a a", "en", "s"),
    ]
    got = quality_rules.quality(docs_of(rows), labels_of(spark, [(5, 1, 0), (None, 1, None)]))
    key = lambda r: (r[0] is None, r[0] or 0)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    expected = []
    for i, t, *_ in rows:
        m = brute_metrics(t)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        expected.append((i, *m, failed, not failed))
    assert sorted(map(tuple, got.select(names).collect()), key=key) == sorted(expected, key=key)
    assert quality_rules.quality(docs_of([]), labels_of(spark, [])).count() == 0


def test_binomial_tail_is_exact(spark):
    cases = [(n, x) for n in (1, 50, 900) for x in (0, 1, 5) if x <= n]
    table = spark.createDataFrame(cases, "n long, x long")
    for p in (0.01, 0.3):
        for n, x, got in table.select("n", "x", quality_rules.binomial_tail(F.col("n"), F.col("x"), p)).collect():
            exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(x + 1))
            assert got == (1.0 if x > n * p else pytest.approx(exact, rel=1e-9))


def test_cutoffs_limit_false_rejections(spark):
    """Good texts have up to 1 % symbols, bad ones 20 %: the rule separates them where labels abound."""
    rnd = random.Random(2)
    rows = []
    for i in range(6000):
        good = i % 3 > 0
        symbols = rnd.randrange(0, 20) if good else 400
        stratum = "few" if i % 100 == 0 else "many"
        rows.append((i, stratum, 400, 2000, symbols, 0, 0, 40, good))
    table = spark.createDataFrame(
        rows,
        "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_lines long, good boolean",
    )
    cutoffs = quality_rules.thresholds(table)
    judged = quality_rules.judged(table, cutoffs)
    lost = {r[0]: r[1] for r in judged.filter("good").groupBy("stratum").agg(F.avg((~F.col("kept")).cast("int"))).collect()}
    assert lost["many"] <= quality_rules.RISK and lost["few"] == 0
    assert judged.filter("stratum = 'many' AND NOT good AND kept").count() == 0
    assert judged.filter("stratum = 'few' AND NOT kept").count() == 0


# --- mixing -------------------------------------------------------------------------------


def brute_mix(rows):
    sizes = [(i, s, len(WORD.findall(t or ""))) for i, t, _, s in rows]
    names = sorted({s for _, s, _ in sizes if s is not None}) + ([None] if any(s is None for _, s, _ in sizes) else [])
    total = {s: sum(n for _, t, n in sizes if t == s) for s in names}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    budget, open_, target = 1.5 * sum(total.values()), list(names), {}
    while open_:
        left = budget - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if level * weight[s] > 2 * total[s]]
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * total[s] for s in above}
        open_ = [s for s in open_ if s not in above]
    return sizes, total, target


def test_mix_meets_its_targets(docs_of, odd_rows):
    rnd = random.Random(4)
    rows = odd_rows + [
        (100 + i, "w " * rnd.randrange(0, 60), "en", rnd.choice(["hot", "hot", "hot", "b", "c", "d", None]))
        for i in range(900)
    ]
    docs = docs_of(rows)
    got = mixing.mix(docs).collect()
    sizes, total, target = brute_mix(rows)
    assert sorted(r.size for r in got) == sorted(n for *_, n in sizes)
    taken, source = Counter(), {i: s for i, s, _ in sizes}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(target[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    longest = {s: max(n for _, t, n in sizes if t == s) for s in total}
    for s in total:
        assert abs(taken[s] - target[s]) <= 2 * longest[s] + 1
    assert sum(taken.values()) <= 1.5 * sum(total.values())
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(docs_of([])).count() == 0
    repeated = mixing.mixed(docs)
    assert repeated.columns == docs.columns
    distinct = {(r.doc_id, r.size, r.taken) for r in got if r.size and r.doc_id not in (None, 5)}
    counted = Counter(r.doc_id for r in repeated.collect())
    assert all(counted[i] == n // size for i, size, n in distinct)


def test_mixed_takes_each_row_as_often_as_the_mix_under_any_column_names(docs_of, odd_rows):
    rnd = random.Random(6)
    rows = odd_rows + [(200 + i, "w " * rnd.randrange(0, 40), "en", rnd.choice(["hot", "hot", "b", None])) for i in range(300)]
    rows += [(7, "same id other text", "en", "b"), (7, "same id other text", "en", "b")]
    docs = docs_of(rows)
    words = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0))
    expected = Counter()
    for r in mixing.mix(docs).collect():
        if r.taken:
            expected[(r.doc_id, r.size)] += r.taken // r.size
    for names in ([], ["_id", "_copies", "_copy", "key", "row", "size", "copies", "last0", "source_size", "i"]):
        named = docs.withColumns({n: F.lit(n) for n in names})
        out = mixing.mixed(named)
        assert out.columns == named.columns
        assert Counter((r.doc_id, r.n) for r in out.select("doc_id", words.alias("n")).collect()) == expected
        assert all(out.filter(F.col(n) != n).count() == 0 for n in names[:3])
    empty = mixing.mixed(docs_of([]))
    assert empty.columns == docs.columns and empty.count() == 0


def test_mixed_shuffles_no_text(docs_of, odd_rows):
    plan = mixing.mixed(docs_of(odd_rows).drop("token"))._jdf.queryExecution().executedPlan().toString()
    # The only exchange is the test table's own.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 0


# --- secrets ------------------------------------------------------------------------------


def brute_base(text):
    text = text or ""
    word = lambda w: "".join(f"[{c}{c.upper()}]" for c in w)
    keys = "|".join(map(word, ("password", "passwd", "secret", "token"))) + "|" + word("api") + "_?" + word("key")
    out = [
        ("assign", m.start(), m.end())
        for m in re.finditer(rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 12
    ]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def secret_rows():
    rnd = random.Random(8)
    random_text = lambda n, letters: "".join(rnd.choice(letters) for _ in range(n))
    rows = [
        (50, "é Password = 'abcdefghijkl' and token:short", "en", "s"),
        (51, "secret: token: abcdefghijklmnop", "en", "s"),
        (52, "AKIA" + "A1" * 8 + " AKIAshort pAsSwD=0123456789abcdef0123", "en", "s"),
        (53, "toKen=ab toſen=abcdefghijklmnop", "en", "s"),
        (54, "user_profile_settings_page_2 http2clientconnectionpool01 ThisIsAVeryLongIdentifier2024", "en", "s"),
    ]
    for i in range(60):
        rows.append((60 + i, "key is " + random_text(40, string.ascii_letters + string.digits), "en", "s"))
    return rows


def test_base_spans_equal_brute_force_and_random_strings_are_found(docs_of, odd_rows):
    rows = odd_rows + secret_rows()
    got = secrets.digest(secrets.scan(docs_of(rows))).collect()
    assert len(got) == len(rows)
    texts = {(i, t) for i, t, *_ in rows}
    by_id = {i: t for i, t in texts}
    for r in got:
        base = brute_base(by_id[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (r, base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for k, *_ in base) for n in secrets.KINDS[:3])
        assert joined == ",".join(s for s in r.spans.split(",") if not s.startswith("random"))
    found = {r.doc_id for r in got if r.n_random}
    assert len(found & set(range(60, 120))) >= 55 and not found - set(range(60, 120))


def test_redaction_replaces_exactly_the_spans(docs_of, odd_rows):
    rows = [r for r in odd_rows if r[0] not in (None, 5)] + secret_rows()
    docs = docs_of(rows)
    spans = {r.doc_id: r.spans for r in secrets.scan(docs).collect()}
    got = secrets.redact(docs)
    assert got.columns == docs.columns
    for r in got.collect():
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        expected = None if text is None else secrets.redacted(text, [tuple(s) for s in spans[r.doc_id]])
        assert r.text == expected and r.n_chars == len(expected or "")
    assert secrets.redacted("ab12cd", [(1, 3, "x"), (2, 4, "y")]) == "a[x]cd"[:4] + "cd"


def test_p_values_of_random_strings_are_even():
    rnd = random.Random(3)
    for e, (_, classes) in enumerate(secrets.ENCODINGS):
        letters = "".join(classes)
        p = [secrets.randomness("".join(rnd.choice(letters) for _ in range(40)), e) for _ in range(600)]
        assert sum(x < 0.05 for x in p) <= 0.1 * len(p)
        assert 0.3 <= sum(x < 0.5 for x in p) / len(p) <= 0.6
    assert all(secrets.randomness(w * 2, 3) < 1e-3 for w in ("internationalisation1", "connectionpoolsize22"))


def test_a_lone_secret_passes_in_every_class():
    """Also below p = 0.5, and whatever few others its class holds; a flood of other strings is kept out."""
    bins = range(secrets.THIN, secrets.BINS)
    for b in bins:
        assert secrets.cutoffs({(7, b): 1})[7] <= b
    assert secrets.cutoffs(dict.fromkeys([(7, b) for b in (5, 8, 10, 14)], 1))[7] <= 5
    rnd = random.Random(5)
    for _, classes in secrets.ENCODINGS:
        for n in secrets.LENGTHS:
            found = 0
            for _ in range(400):
                text = "is " + "".join(rnd.choices("".join(classes), k=n)) + "."
                base = secrets.base_spans(text)
                tested = secrets.candidates(text, base)
                passing = secrets.cutoffs(Counter((c, b) for _, _, c, b in tested))
                spans = secrets.found_spans(text, passing)
                found += not tested or any(start == 3 and end == 3 + n for start, end, _ in spans)
            assert found >= 380
    uniform = {(7, b): round(20_000 * (e - s)) for b, (s, e) in enumerate(zip(secrets.EDGES, (*secrets.EDGES[1:], 1)))}
    assert secrets.cutoffs(uniform)[7] == 0
    flood = {**uniform, (7, 0): 20_000, (7, 2): 20_000, (7, 3): 20_000, (7, 4): 20_000}
    assert secrets.cutoffs(flood)[7] == 5


def test_secrets_in_paths_and_behind_prefixes_are_found(docs_of):
    """Also where a run mixes both base64 alphabets, is mostly text, is short, or has letters alone."""
    rnd = random.Random(12)

    def secret(letters, n):
        while True:
            s = "".join(rnd.choices(letters, k=n))
            e = secrets.encoding_of(s)
            if secrets.randomness(s, e) >= 0.3 and all(c in s for c in letters[62:]) and s[0] + s[-1] == re.sub(r"\W|_", "", s[0] + s[-1]):
                return s

    word = string.ascii_letters + string.digits
    hidden = [
        ("/account/reset/", secret(word + "-_", 40)),
        ("key-", secret(word + "+/", 40)),
        ("sk_live_", secret(word + "+/", 40)),
        ("/services/T0/B0/incoming/webhooks/internationalisation/of/the/", secret(word, 32)),
        ("/files/0123456789abcdef0/of/the/", secret(word, 32)),
        ("", secret(word + "+/", 16)),
        ("", secret(string.digits + "ABCDEF", 16)),
        ("", secret(string.ascii_letters, 40)),
    ]
    docs = docs_of([(i, f"see {a}{b} .", "en", "s") for i, (a, b) in enumerate(hidden)])
    spans = {r.doc_id: [s for s in r.spans if s.kind == "random"] for r in secrets.scan(docs).collect()}
    texts = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    for i, (a, b) in enumerate(hidden):
        start = 4 + len(a)
        assert any(s.start <= start and s.end >= start + len(b) for s in spans[i]), (a, b, spans[i])
        assert all(x.end <= y.start for x, y in zip(spans[i], spans[i][1:]))
        assert b not in texts[i]


# --- trained scorers ----------------------------------------------------------------------

WORDS = {
    "en": "the of and to in that was for with his they from have this which would there".split(),
    "de": "der die und das nicht eine mit für werden über auch schön haben könnte straße".split(),
    "fr": "les des est une dans pour qui été avec sur mais être où très façon même".split(),
}


def prose(rnd, lang, n):
    return " ".join(rnd.choice(WORDS[lang]) for _ in range(n))


def language_rows(n):
    rnd = random.Random(5)
    return [(1000 + i, prose(rnd, lang := rnd.choice(list(WORDS)), rnd.randrange(20, 80)), lang, "s") for i in range(n)]


def test_languages_of_held_out_texts(docs_of, odd_rows):
    rows = language_rows(400)
    got = {r.doc_id: r for r in language_id.identify(docs_of(rows + odd_rows)).collect() if r.doc_id is not None}
    for i, _, lang, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].lang_pred == lang and 0 <= got[i].score <= 1
    assert {got[i].lang_pred for i in (1, 2, 3)} == {"und"}
    assert got[7].lang_pred != "und"
    none = language_id.identify(docs_of([(1, "text", None, None)])).first()
    assert (none.lang_pred, none.score) == ("und", 0.0)
    assert language_id.identify(docs_of([])).count() == 0


def test_codewords_differ_in_many_bits():
    for n in (2, 4, 7, 12):
        code = language_id.codewords(n)
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert len(code) == n and apart >= max(1, code.shape[1] // 3)


def toxic_rows(n):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = prose(rnd, "en", 60).split() + [f"r{rnd.randrange(5000)}" for _ in range(20)]
        toxic = int(rnd.random() < 0.2)
        for _ in range(4 * toxic):
            words.insert(rnd.randrange(len(words)), rnd.choice(["awfulword", "nastyword", "vileword"]))
        rows.append((2000 + i, " ".join(words), "en", "s"))
        labels.append((2000 + i, 1, toxic))
    return rows, labels


def test_toxicity_of_held_out_texts(spark, docs_of, odd_rows):
    rows, labels = toxic_rows(600)
    table = labels_of(spark, [*labels, (None, 1, 1), (99999, 1, 1), (9, 1, None)])
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs_of(rows + odd_rows), table).collect()}
    right = [got[i].predicted == t for i, _, t in labels if got[i].held_out]
    assert sum(right) >= 0.99 * len(right) and len(right) > 80
    assert all(got[i].predicted == 0 and 0 <= got[i].score < 0.5 for i in (None, 1, 2, 3, 7))
    assert toxicity.score_toxicity(docs_of(odd_rows), labels_of(spark, [])).filter("score > 0").count() == 0
    assert toxicity.score_toxicity(docs_of([]), table).count() == 0


def test_toxicity_learns_from_all_labels(spark, docs_of):
    """Words that only 6 of 6 000 labelled texts hold; half of the near copies' labels are wrong on one id."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(7))
    held = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 5 == 0]
    known = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 5 != 0][:6_000]
    marks = [f"zz{'qxvwk'[i // 5]}{'qxvwk'[i % 5]}z" for i in range(12)]
    rows, labels = [], []
    for at, i in enumerate(known):
        mark = marks[at // 6] if at < 72 else word()
        rows.append((i, " ".join([word() for _ in range(8)] + [mark]), "en", "s"))
        labels.append((i, 1, int(at < 72)))
    rows += [(held[k], " ".join([word() for _ in range(8)] + [m]), "en", "s") for k, m in enumerate(marks)]
    rows += [(i, " ".join(word() for _ in range(9)), "en", "s") for i in held[12:40]]
    got = toxicity.score_toxicity(docs_of(rows), labels_of(spark, labels)).collect()
    assert {r.doc_id for r in got if r.held_out and r.predicted} == set(held[:12])
    assert len(got) == len(rows)


def test_toxicity_uses_all_terms_of_all_texts(spark, docs_of):
    """No term of these examples is frequent, or mostly toxic: each is in two texts, copies of no other."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(4))
    held = [i for i in range(2_000) if zlib.crc32(str(i).encode()) % 5 == 0][:40]
    known = [i for i in range(2_000) if zlib.crc32(str(i).encode()) % 5 != 0][:80]
    rows, labels = [], []
    for at, i in enumerate(known):
        words = [word() for _ in range(30)] if at % 2 == 0 else [*words[15:], *(word() for _ in range(15))]
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(at < 40)))
        if at % 2 == 0:
            rows.append((held[at // 2], " ".join(rnd.sample(words[:15], 15) + [word() for _ in range(10)]), "en", "s"))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs_of(rows), labels_of(spark, labels)).collect()}
    assert all(got[held[k]].predicted == int(k < 20) for k in range(40))


def test_term_weights_hold_every_term(spark, docs_of):
    import numpy as np

    some = [(1, 1, "Worda worda pair ß é longerword"), (2, 0, "pair x"), (3, 0, ""), (4, 0, None), (5, 1, "longerly\u2014x")]
    learned = spark.createDataFrame(some, "doc_id long, toxic int, text string")
    (hashes, numbers), weights = toxicity.term_weights(learned, 5, 2)
    terms = [toxicity.terms(t or "") for _, _, t in some]
    n = {t: sum(t in own for own in terms) for t in set().union(*terms)}
    k = {t: sum(t in own for own, (_, label, _) in zip(terms, some) if label) for t in n}
    spread = {t: n[t] * 0.4 * 0.6 * (5 - n[t]) / 4 for t in n}
    wanted = [(math.log(6 / (n[t] + 1)) + 1e-9) * math.hypot(1, (k[t] - n[t] * 0.4) / math.sqrt(spread[t] + 1)) for t in n]
    assert len(hashes) == len(set(numbers.tolist())) == len(n)
    assert np.allclose(sorted(weights[:-1]), sorted(wanted)) and math.isclose(weights[-1], math.log(6))
    doc, found, counts = toxicity.term_hashes([t for _, _, t in some])
    for i, own in enumerate(terms):
        assert sorted(own.values()) == sorted(counts[doc == i].tolist())
    assert set(found.tolist()) == set(hashes.tolist())


def test_votes_equal_brute_force_over_all_terms(spark, docs_of):
    import numpy as np

    rnd = random.Random(13)
    rows = [(i, prose(rnd, "en", 12) + f" {''.join(rnd.choice('abcde') for _ in range(6))} unseen", "en", "s") for i in range(60)]
    rows += [(60, rows[0][1], "en", "s"), (61, "", "en", "s"), (62, None, "en", "s"), (63, "zzz yyy", "en", "s"), (None, "word", "en", "s")]
    docs = docs_of(rows).select("doc_id", "text")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)], "doc_id long, toxic int")
    _, chosen = toxicity.examples_of(docs, labels)
    label = {r.doc_id: r.toxic for r in chosen.collect()}
    terms = [toxicity.terms(t or "") for _, t, _, _ in rows]
    total, prior = len(label), sum(label.values()) / len(label)
    n = Counter(t for i in label for t in terms[i])
    k = Counter(t for i in label if label[i] for t in terms[i])
    place = {t: at for at, t in enumerate(sorted(set().union(*terms)))}
    vectors = np.zeros((len(rows), len(place)))
    for row, own in zip(vectors, terms):
        for t, c in own.items():
            spread = n[t] * prior * (1 - prior) * (total - n[t]) / (total - 1)
            weight = (math.log((total + 1) / (n[t] + 1)) + 1e-9) * math.hypot(1, (k[t] - n[t] * prior) / math.sqrt(spread + 1))
            row[place[t]] = (1 + math.log(c)) * weight
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-300)
    found, _, _ = toxicity.votes_of(docs, labels)
    got = {r.doc_id: r.vote for r in found.collect()}
    for (i, *_), row in zip(rows, vectors):
        cosines = sorted(((float(row @ vectors[e]), label[e]) for e in label), reverse=True)[: toxicity.NEIGHBOURS]
        wanted = (sum(c * x for c, x in cosines) + prior * prior) / (sum(c for c, _ in cosines) + prior)
        assert math.isclose(got[i], wanted, rel_tol=1e-4), i
    assert len(got) == len(rows)


def test_near_copies_are_one_example_with_the_label_of_most(spark, docs_of):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{base} end{i}", "en", "s") for i in (1, 2, 3)]
    rows += [(4, " ".join(f"v{i}" for i in range(60)), "en", "s"), (5, "", "en", "s"), (6, None, "en", "s")]
    docs = docs_of(rows).select("doc_id", "text")
    labels = labels_of(spark, [(1, 1, 0), (2, 1, 1), (3, 1, 1), (4, 1, 0), (5, 1, 0), (6, 1, 1), (7, 1, 1)])
    _, chosen = toxicity.examples_of(docs, labels.select("doc_id", "toxic"))
    assert sorted(map(tuple, chosen.collect())) == [(1, 1), (4, 0), (5, 0), (6, 1)]


def test_neighbours_in_chunks_equal_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    idf = rng.uniform(1, 3, 30)
    made = set()
    for _ in range(500):
        which = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        made.add(tuple(int(x) for t in which for x in (t, rng.integers(1, 4))))
    made = sorted(made)
    voters = [(i, list(c), 1, i % 2) for i, c in enumerate(made[::2])]
    table = spark.createDataFrame(voters, "voter long, counts array<int>, n long, toxic long")
    queries = spark.createDataFrame([(list(c),) for c in made], "counts array<int>")
    dense = np.zeros((len(made), 30))
    for row, c in zip(dense, made):
        which, weight = toxicity.unit_vector(list(c), idf)
        row[which] = weight
    full = dense @ dense[::2].T
    for chunk in (1 << 16, 40):
        got = {tuple(r.counts): r.near for r in toxicity.neighbours(table, queries, idf, chunk).collect()}
        assert len(got) == len(made)
        for c, scores in zip(made, full):
            wanted = -np.sort(-scores)[: toxicity.NEIGHBOURS + 1]
            assert np.allclose([-v.far for v in got[c]], wanted[wanted > 1e-12])
            assert np.allclose([scores[v.voter] for v in got[c]], [-v.far for v in got[c]])


def test_block_max_search_is_exact():
    import numpy as np

    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(300):
        which = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        weight = rng.integers(1, 4, len(which)).astype(float)
        vectors.append((which, weight / np.sqrt((weight**2).sum())))
    index = toxicity.BlockMaxIndex(vectors, np.zeros(300), 40)
    for q in range(0, 300, 7):
        rows, scores = index.nearest(*vectors[q], 25)
        dense = np.zeros(40)
        dense[vectors[q][0]] = vectors[q][1]
        full = index.matrix @ dense
        best = np.lexsort((np.arange(300), -np.round(full, 12)))[:25]
        best = best[full[best] > 0]
        assert np.allclose(scores, full[best]) and len(rows) == len(best)


def test_importance_sample_prefers_the_target(spark, docs_of, odd_rows):
    rows, labels = toxic_rows(300)
    junk = [(5000 + i, "zzqx kkvw " * 40 + str(i), "en", "s") for i in range(60)]
    table = labels_of(spark, [(i, 1, 0) for i, *_ in rows] + [(i, 0, 0) for i, *_ in junk])
    docs = docs_of(rows + junk)
    got = importance.sample(docs, table, share=0.8).collect()
    assert sum(r.kept for r in got) == math.ceil(0.8 * len(got))
    kept = {r.doc_id for r in got if r.kept}
    assert len(kept & {i for i, *_ in junk}) == 0
    keys = sorted((r.key for r in got), reverse=True)
    assert {r.doc_id for r in got if r.key >= keys[len(kept) - 1]} == kept
    again = importance.sample(docs.repartition(7), table, share=0.8).collect()
    assert kept == {r.doc_id for r in again if r.kept}
    odd = importance.sample(docs_of(odd_rows), labels_of(spark, []), share=0.5)
    assert odd.count() == len(odd_rows) and odd.filter("log_weight IS NULL OR isnan(log_weight)").count() == 0
    assert importance.sample(docs_of([]), table).count() == 0
