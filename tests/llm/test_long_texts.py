"""Texts with very many matches and very long tokens: the work grows in proportion."""

import random
import time

from parcelwise.llm import pii, secrets


def took(df):
    start = time.perf_counter()
    rows = df.collect()
    return rows, time.perf_counter() - start


def test_a_hundred_thousand_matches(spark):
    rng = random.Random(1)
    names = [f"user{k}" for k in range(100_000)]
    text = " ".join(f"{n}@mail{rng.randrange(9)}.example.org" for n in names)
    docs = spark.createDataFrame([(1, text, None)], "doc_id long, text string, x string")
    found, seconds = took(pii.add_entities(docs, "text").select("_email"))
    spans = found[0]["_email"]
    assert len(spans) == 100_000 and all(text[s["start"] : s["end"]] == s["value"] for s in spans[::997]) and spans[-1]["end"] == len(text)
    assert seconds < 25, seconds
    rows = pii.add_entities(docs, "text")
    clean, seconds = took(rows.select(pii.redact(rows["_text"], rows["_email"], lambda s: pii.F.lit("<E>")).alias("t")))
    assert clean[0]["t"] == " ".join(["<E>"] * 100_000) and seconds < 40, seconds


def test_overlapping_spans_across_blocks(spark):
    from parcelwise.llm.spans import BLOCK, redact

    text = "".join(chr(97 + k % 26) if k % 7 else "é" for k in range(9 * BLOCK))
    spans = sorted((k * 4, k * 4 + 2 + 9 * (k % 50 == 0)) for k in range(2 * BLOCK))
    want, at = "", 0
    for a, b in spans:
        want, at = want + text[at : max(a, at)] + "#", max(at, b)
    rows = spark.createDataFrame([(text, [("k", a, b, "") for a, b in spans])], "t string, s array<struct<kind:string,start:int,end:int,value:string>>")
    assert rows.select(redact(rows["t"], rows["s"], lambda s: pii.F.lit("#"))).first()[0] == want + text[at:]


def test_a_token_of_a_million_symbols(spark):
    rng = random.Random(2)
    token = "".join(rng.choice(secrets.BASE64) for _ in range(1_000_000))
    docs = spark.createDataFrame([(1, f"data {token} end")], "doc_id long, text string")
    rows, seconds = took(secrets.secret_report(docs))
    assert rows[0]["spans"] == "random:5:1000005" and seconds < 40, seconds
