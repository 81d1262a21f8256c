"""Positional votes of rare words against a plain search, and mentions that are no licence."""

import random

import pytest

from parcelwise.llm import licenses as L


def in_order(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = list(row)
        for k, y in enumerate(b, 1):
            row[k] = last[k - 1] + 1 if x == y else max(last[k], row[k - 1])
    return row[-1]


def voted(index, name, words):
    """Every start that begins a voted band, by trying all of them."""
    voters, size = index.voters[name], len(index.words[name])
    drift, need = L.drift_of(size), L.VOTED * sum(index.idf[w] for w, _ in index.voters[name])
    starts = set()
    for s in range(-size - drift, len(words) + 1):
        agree = [w for w, place in voters if any(0 <= s + d + place < len(words) and words[s + d + place] == w for d in range(drift + 1))]
        if sum(index.idf[w] for w in agree) >= need * (1 - 1e-9):
            starts.add(s)
    return starts, drift


@pytest.mark.parametrize("seed", range(6))
def test_bands_equal_a_search_over_all_starts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)]
    text = " ".join(rng.choice(vocabulary) for _ in range(14))
    index = L.build_index({"t": (text, [text.split()[3]])}, {w.encode(): rng.randrange(1, 90) for w in vocabulary}, 100)
    some = False
    for _ in range(60):
        words = [rng.choice(vocabulary).encode() for _ in range(rng.randrange(60))]
        if rng.random() < 0.6:
            piece = [w for w in index.words["t"] if rng.random() < 0.85]
            cut = rng.randrange(len(words) + 1)
            words[cut:cut] = [x for w in piece for x in ([w] if rng.random() < 0.8 else [w, b"more"])]
        at = {}
        for i, w in enumerate(words):
            if w in index.idf:
                at.setdefault(w, []).append(i)
        bands = L.voted_bands(index.voters["t"], at, index.idf, L.drift_of(14))
        starts, drift = voted(index, "t", words)
        some |= bool(starts)
        assert bool(bands) == bool(starts)
        for low, high in bands:
            assert any(s <= low and low <= s + drift for s in starts)
        for s in starts:
            assert any(low <= s + drift and high >= s for low, high in bands)
    assert some


def test_found_templates_have_votes_key_phrases_and_order():
    rng = random.Random(9)
    texts = {name: L.TEMPLATES[name] for name in ("mit", "apache-2.0", "bsd", "isc", "lgpl", "mpl-2.0", "cc-by-nc", "cc0")}
    index = L.build_index(texts, {b"the": 90, b"license": 20, b"software": 30}, 100)
    every = [w for x in index.words.values() for w in x] + [b"other"] * 40
    hits = 0
    for _ in range(250):
        words = [rng.choice(every) for _ in range(rng.randrange(30))]
        name = rng.choice(list(texts))
        keep = rng.choice([1.0, 0.95, 0.85, 0.6])
        piece = [x for w in index.words[name] if rng.random() < keep for x in ([w] if rng.random() < 0.9 else [w, b"inserted"])]
        words[len(words) // 2 : len(words) // 2] = piece
        found = L.scan(words, index)
        for t, share in found.items():
            assert share >= L.MATCH and in_order(words, index.words[t]) / len(index.words[t]) >= share
            assert all(any(words[i : i + len(k.words)] == k.words for i in range(len(words))) for k in index.keys[t])
        if piece == index.words[name]:
            hits += 1
            assert found[name] == 1.0
        whole = all(any(piece[i : i + len(k.words)] == k.words for i in range(len(piece))) for k in index.keys[name])
        if whole and in_order(piece, index.words[name]) == len(index.words[name]):
            assert found.get(name, 0.0) >= L.MATCH
    assert hits > 5


@pytest.mark.parametrize(
    "text",
    [
        "We do not use the Apache License, Version 2.0 here; this text is proprietary.",
        "unlike the GNU Lesser General Public License, ours forbids copying",
        "the song cc by nc was good",
        "See also: Mozilla Public License 2.0, Apache License, Version 2.0, CC BY-SA and others.",
        "He wrote about software released into the public domain, free and unencumbered by design.",
        "Licensed to kill, under cover; the apache pilot saw version 2 of the film 0 times. License plates!",
    ],
)
def test_a_mention_is_no_licence(text):
    index = L.build_index(L.TEMPLATES, {w: 3 for w in (b"license", b"the", b"licensed", b"under", b"public")}, 50)
    assert L.scan_text(text.encode(), L.words_of(text.encode()), index) == {}
