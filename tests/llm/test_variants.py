import random
import re
import zlib
from collections import Counter

import pytest

from parcelwise.llm import variants as V

DOCS = "doc_id long, text string, word string, n long"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_words(rows, least=7, count=2, noise=31):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= count}


def brute_variants(n, ratio=10):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), None if form[w] is None else n[form[w]]) for w in n}


def random_words(seed, size, letters="abé", lengths=(7, 8, 9, 12)):
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))
        words.add(w)
        k = rng.randrange(len(w))
        words |= {w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]}
    return {w: rng.choice([2, 3, 25, 400, 5000]) for w in sorted(words) if len(w) >= 7}


@pytest.mark.parametrize("bin_words,side", [(512, 2048), (3, 2), (10_000, 7)])
def test_near_words_of_random_words_match_all_pairs(spark, bin_words, side):
    n = random_words(bin_words, 250)
    got = V.near_words(spark.createDataFrame(list(n.items()), "word string, n long"), bin_words, side).collect()
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    want = {}
    for w, v in near.items():
        if v:
            best = min(v, key=lambda x: (-n[x], x))
            want[w] = (len(v), best, n[best])
    assert len(got) == len(want) and {r["word"]: (r["n_near"], r["best"], r["best_n"]) for r in got} == want


def test_variants_of_given_texts_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    n = brute_words([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    found = V.spelling_variants(V.document_words(docs, noise=31)).collect()
    assert len(found) == len(n) and {tuple(r) for r in found} == brute_variants(n)


def test_odd_rows(spark):
    rows = [(1, "Straße STRASSEN×÷ naïveté Naïveté naÏveté"), (1, "Straße STRASSEN×÷ naïveté Naïveté naÏveté"), (None, "missing missing"), (2, None), (3, ""), (4, "日本abcdefg日本abcdefg Ābcdefgh")]
    docs = spark.createDataFrame([(a, b, "clash", 7) for a, b in rows], DOCS)
    n = brute_words(rows)
    assert {tuple(r) for r in V.document_words(docs, noise=31).collect()} == set(n.items())
    assert {tuple(r) for r in V.spelling_variants(V.document_words(docs, noise=31)).collect()} == brute_variants(n)
    empty = V.spelling_variants(V.document_words(docs.limit(0)))
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_chains_end_at_their_root_and_long_words_are_compared(spark):
    n = {"abcdefg": 5, "abcdefgh": 60, "abcdefghi": 700, "abcdefghij": 8000, "x" * 50_000: 2, "x" * 50_001: 20}
    got = {tuple(r) for r in V.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert got == brute_variants(n) and ("abcdefg", "abcdefgh", "abcdefghij", 5, 1, 60) in got


def test_pieces_cut_no_run(monkeypatch):
    monkeypatch.setattr(V, "PIECE", 8)
    text = "Abc defghijklmnopqrstuv 1 wxyzé, ende" * 5
    runs = [r.decode("latin-1") for p in V.run_pieces(text) for r in p]
    assert runs == [r.replace("A", "a") for r in re.findall("[A-Za-zÀ-ÿ]+", text)]
