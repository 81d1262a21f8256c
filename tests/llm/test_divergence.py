import random
import re
from collections import Counter, defaultdict

import pytest

from parcelwise.llm import divergence as D

SCHEMA = "lang string, source string, text string, term string, n long"


def brute(rows, least=10, top=10):
    docs, groups = defaultdict(Counter), {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        docs[lang].update(set(words))
        groups.setdefault((lang, source), Counter()).update(words)
    out = set()
    for (lang, source), n in groups.items():
        kept = [t for t, k in docs[lang].items() if k >= least]

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = shares(n)
        everything = sum((c for (g, _), c in groups.items() if g == lang), Counter())
        q = shares(everything)
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [(s, sum(gap(p[t], r[t]) for t in kept)) for (g, s), c in groups.items() if g == lang and s != source for r in [shares(c)]]
        terms = [(t, gap(p[t], q[t])) for t in kept if n[t] > 0 and p[t] > q[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, part, item, value, k) for k, (item, value) in enumerate(ordered[:most], 1)}
    return out


def random_rows(seed, groups=7, docs=160):
    rng = random.Random(seed)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)] + ["Ünï", "日本"]
    rows = []
    for _ in range(docs):
        g = rng.randrange(groups)
        rows.append((rng.choice(["en", "de"]), f"s{g}", " ".join(rng.choice(words[g * 3 : g * 3 + 40]) for _ in range(rng.randrange(30)))))
    return rows


@pytest.mark.parametrize("block,shard", [(1024, 2_000_000), (2, 2_000_000), (3, 20)])
def test_audit_matches_brute_force_in_any_cut(spark, block, shard):
    rows = random_rows(block) + [(None, None, "x"), (None, "a", None), ("fr", "only", "y " * 50), ("en", "silent", ""), ("en", "blank", "12 34")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = [tuple(r) for r in D.audit_sources(docs, block=block, shard=shard).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_ties_and_repeated_rows(spark):
    rows = [("en", s, "same words here, twice the words") for s in "abc" for _ in range(12)] + [("en", "d", "words and other words")] * 11
    got = {tuple(r) for r in D.audit_sources(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)).collect()}
    assert got == brute(rows)


def test_empty_table(spark):
    found = D.audit_sources(spark.createDataFrame([], SCHEMA))
    assert found.collect() == [] and found.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_shares_of_huge_counts_are_exact(spark):
    n, total, kept = 4 * 10**15 + 7, 9 * 10**16 + 11, 3 * 10**9 + 1
    row = spark.createDataFrame([(n, total, kept)], "n long, t long, v long")
    assert row.select(D.share(row.n, row.t, row.v)).first()[0] == 1 + 10**9 * (n + 2) // (total + 2 * kept)


def test_pieces_cut_no_term(monkeypatch):
    monkeypatch.setattr(D, "PIECE", 8)
    text = "Abc defghijklmnopqrstuv 1 wxyzé日本, ende" * 4
    terms = [t.decode() for p in D.term_pieces(text.encode()) for t in p]
    assert terms == [t.replace("A", "a") for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
