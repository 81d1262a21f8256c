"""URL filters, WARC archives, packing and the pipeline."""

import base64
import hashlib
import random
import struct

import numpy as np
import pytest

import duckdb

import corpus_pipeline
from parcelwise.llm.oracles import ORACLE
from parcelwise.llm import packing, urls, warc
from parcelwise.llm.common import new_path

PAGES = "page_id int, url string, html string, host string, verdict int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", 1) for r in rows], PAGES)


def test_rules_and_aliases(spark):
    rows = [
        (1, "https://a.org/x", '<link rel="canonical" href="https://b.net/es/1">'),
        (2, "https://b.net/es/1", None),
        (3, "http://c.org/#t", '<META HTTP-EQUIV="refresh" content="0; url=/y">'),
        (4, "http://c.org/y", "<link href='https://x.com/z' rel=canonical>"),
        (5, None, ""),
        (6, "foo", ""),
        (7, "HTTP://WWW.Example.com/en/a?b", ""),
        (8, "http://m.example.com/en/", ""),
        (9, "http://example.com?x", ""),
        (10, "http://e.org/1", ""),
        (11, "http://d.org/1", '<link rel="canonical" href="http://q.net/fr/2"><link rel=canonical href="http://ok.com/">'),
        (1, "https://a.org/x", ""),
    ]
    logged = spark.createDataFrame([("http://e.org/1", "http://f.org/2"), ("http://f.org/2", "http://g.net/fr/3"), (None, "x")], "source string, target string")
    got = {r.page_id: r for r in urls.judge_urls(pages(spark, rows), logged).collect()}
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "block", 11: "allow"}
    assert (got[7].host, got[7].path, got[7].rule) == ("www.example.com", "/en/a", "www.example.com/en/")
    assert (got[5].host, got[5].path, got[6].host, got[9].path) == ("", "", "", "")
    assert urls.judge_urls(pages(spark, rows), logged).count() == len(rows)
    assert urls.judge_urls(pages(spark, []).limit(0)).count() == 0


def test_relative_links_and_url_forms(spark):
    head = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://blocked.net/es/x", head.format("http://a.org/y")),
        (2, "http://a.org/deep/page", head.format("../y")),
        (3, "HTTP://B.org:80", '<meta http-equiv=refresh content="0;url=http://a.org/deep/./../y">'),
        (4, "http://c.org/list?id=1", head.format("?id=3")),
        (5, "http://c.org/list?id=3", head.format("//a.org/y#top")),
        (6, "http://b.org/", None),
        (7, "http://d.org/s/t", head.format("page.html")),
        (8, "http://d.org/s/page.html", head.format("mailto:x@a.org")),
        (9, "http://d.org/s/other", head.format("javascript:go('http://a.org/y')")),
        (10, "https://b.org/", head.format("#")),
    ]
    table = pages(spark, rows)
    got = {r.page_id: r.verdict for r in urls.judge_urls(table).collect()}
    assert {k for k, v in got.items() if v == "block"} == {1, 2, 3, 4, 5, 6}
    edges = {tuple(r) for r in urls.page_links(table).collect()}
    assert ("http://d.org/s/t", "http://d.org/s/page.html") in edges and not any(a.startswith("https") or "other" in a for a, _ in edges)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert {r[0]: r[-1] for r in con.execute(ORACLE["op3_url_filters"]).fetchall()} == got


def test_archives_round_trip(spark):
    rows = [(i, f"http://x/{i}", f"<p>page {i % 7} " + "word " * (i % 50)) for i in range(300)]
    rows += [(1000, None, None), (1001, "a\nb: c", ""), (1002, "x", "same"), (1003, "y", "same"), (1004, "z", "a\r\n\r\nb"), (1005, "w", "x" * 2_000_000)]
    rows += [(1002, "x", "same"), (None, "q", "same"), (None, "n", "nn"), (None, "n", "nn")]
    found = warc.write_archives(pages(spark, rows), new_path(spark, "warc"))
    got = warc.read_archives(found, payloads=True).collect()
    low = {}
    for i, _, h in rows:
        if i is not None:
            low[h or ""] = min(i, low.get(h or "", i))
    want = []
    for i, _, h in rows:
        data, first = (h or "").encode(), low.get(h or "")
        revisit = first is not None and i != first
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None, b"" if revisit else data))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)
    assert warc.archive_pages(pages(spark, []).limit(0)).count() == 0
    smaller = warc.archive_pages(pages(spark, rows), min_bytes=10).where("payload_bytes < 10")
    assert {r.record_type for r in smaller.collect()} == {"response"}


def test_archive_format(tmp_path):
    records = [warc.record(i, "http://u", b"payload %d" % i * 20, "D", None) for i in range(30)]
    archive = warc.Archive(str(tmp_path / "a.warc.zst"), records)
    for r in records:
        archive.add(r)
    archive.close()
    raw = (tmp_path / "a.warc.zst").read_bytes()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and raw[8 + size : 12 + size] == b"\x28\xb5\x2f\xfd" and raw.count(b"\x28\xb5\x2f\xfd") >= 30
    assert list(warc.read_archive(str(tmp_path / "a.warc.zst"))) == records
    (tmp_path / "cut.warc.zst").write_bytes(raw[:-3])
    with pytest.raises(ValueError):
        list(warc.read_archive(str(tmp_path / "cut.warc.zst")))


def slow_best_fit(lengths, opened):
    bins = []
    for n in lengths:
        fits = [b for b in bins if b[0] - b[1] >= n]
        if fits:
            best = min(fits, key=lambda b: b[0] - b[1])
        else:
            best = [opened(n), 0]
            bins.append(best)
        best[1] += n
    return sorted(map(tuple, bins))


def test_best_fit_equals_brute_force():
    rng = random.Random(4)
    for _ in range(20):
        lengths = sorted((rng.randrange(1, 65) for _ in range(120)), reverse=True)
        opened = lambda n: 32 if n <= 32 else 64
        at, offset = packing.best_fit(np.array(lengths), opened, 64)
        bins = {}
        for n, b, o in zip(lengths, at.tolist(), offset.tolist(), strict=True):
            size, used = bins.get(b, (opened(n), 0))
            assert o == used
            bins[b] = (size, used + n)
        assert sorted(bins.values()) == slow_best_fit(lengths, opened)


def test_joint_sizes_cost_no_more_than_any_single_rule():
    lengths = np.array(sorted((random.Random(9).choices(range(1, 65), k=400)), reverse=True))
    sizes = (16, 32, 64)
    at, _, final = packing.pack(lengths, sizes, float)
    cost = sum({b: c for b, c in zip(at.tolist(), final.tolist(), strict=True)}.values())
    for floor in sizes:
        bins = slow_best_fit(lengths.tolist(), lambda n, f=floor: min(s for s in sizes if s >= max(n, f)))
        assert cost <= sum(min(s for s in sizes if s >= used) for _, used in bins)


def test_packing_keeps_every_token(spark):
    rows = [(i, "w " * (i * 7 % 90)) for i in range(200)] + [(None, "a b"), (5, "x y z"), (5, "x y z"), (900, None), (901, ""), (902, "w " * 1000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, capacity int")
    got = packing.pack_documents(docs, packing.words(), capacities=(16, 32, 64), shard_rows=50).collect()
    bins = {}
    for r in got:
        if r.bin_id is None:
            assert r.n_tokens == 0 and r.capacity is None
        else:
            bins.setdefault(r.bin_id, []).append(r)
    for members in bins.values():
        members.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.n_tokens for r in members])
        assert [r.offset for r in members] == [0, *ends[:-1].tolist()] and len({r.capacity for r in members}) == 1
        assert members[0].capacity == min(s for s in (16, 32, 64) if s >= ends[-1])
    assert sum(r.n_tokens for r in got) == sum(len((t or "").split()) for _, t in rows)
    assert sorted(r.start for r in got if r.doc_id == 902) == list(range(0, 1000, 64))
    assert packing.pack_documents(docs.limit(0), packing.words()).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(60, 200))) for _ in range(30)]
    rows = [(i, t + f" mail{i}@x.org") for i, t in enumerate(texts)] + [(100, texts[0] + " mail0@x.org"), (101, "short"), (102, None), (103, "spam spam ham " * 40)]
    rows += [(3, texts[3] + " mail3@x.org"), (None, texts[4] + " mail4@x.org")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "fp") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, fp string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in [*range(30), 100]], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], str(tmp_path)))
    good, once, clean, packed = steps[1:]
    assert good.columns == once.columns == clean.columns == docs.columns
    assert {101, 102, 103}.isdisjoint(r.doc_id for r in good.collect()) and good.count() == 33
    kept = sorted((r.doc_id is None, r.doc_id) for r in once.collect())
    assert kept == [(False, i) for i in range(30)]  # the row without an id repeats text 4
    for r in clean.collect():
        assert "@" not in r.text and "<EMAIL>" in r.text and r.n_chars == len(r.text)
    assert sum(r.n_tokens for r in packed.collect()) == sum(len(r.text.split()) for r in clean.collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "pii_disclosure", "best_fit_packing"]


def test_near_duplicate_stage_keeps_other_texts_of_a_shared_id(spark):
    a, b = "one two three four five six seven eight nine ten", "nothing like the other text at all in any of its words"
    rows = [(1, a, 1, "x"), (7, a, 2, "x"), (7, b, 3, "x"), (7, b, 3, "x"), (None, b, 4, "x"), (None, "alone " * 9, 5, "x"), (None, "alone " * 9, 5, "x"), (8, None, 6, "x"), (9, "", 7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _again int, key string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["_again"]) for r in kept.collect()) == [(-1, 5), (1, 1), (7, 3), (8, 6)]
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").collect() == []
