"""Periodic runs against a brute-force search, and extensions against direct comparison."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from haulbook.llm import periodic
from haulbook.llm.periodic import COVER, MODULUS, Extensions, cover_shifts, find_runs, planted_places, run_report, word_runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every maximal stretch of every period, straight from the definition."""
    n, seen = len(words), set()
    for p in range(1, n // 4 + 1):
        s = 0
        while s < n - p:
            if words[s] != words[s + p]:
                s += 1
                continue
            e = s
            while e < n - p and words[e] == words[e + p]:
                e += 1
            length = e - s + p
            if length >= max(6, 4 * p) and not any((s, length, q) in seen for q in range(1, p)):
                seen.add((s, length, p))
            s = e
    return sorted(seen, key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_cover_meets_every_pair_of_residues():
    shifts = cover_shifts()
    assert shifts.min() >= 0 and shifts.max() < MODULUS
    assert all((a + shifts[a, b]) % MODULUS in COVER and (b + shifts[a, b]) % MODULUS in COVER
               for a in range(MODULUS) for b in range(MODULUS))


@pytest.mark.parametrize("kinds", [1, 2, 5])
def test_extensions(kinds):
    draw = np.random.default_rng(kinds)
    codes = np.concatenate([draw.integers(0, kinds, 150), np.tile(draw.integers(0, kinds, 40), 4)])
    common = Extensions(codes)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(codes)), np.arange(len(codes))))
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i, j, common(i, j)):
        m = 0
        while max(a, b) + m < len(codes) and codes[a + m] == codes[b + m]:
            m += 1
        assert m == got


@pytest.mark.parametrize("pairs", [7, 1 << 20])
def test_runs_agree_with_brute_force(pairs, monkeypatch):
    monkeypatch.setattr(periodic, "GRID_PAIRS", pairs)
    draw = np.random.default_rng(3)
    for trial in range(150):
        parts = [np.tile(draw.integers(0, 3, draw.integers(1, 12)), draw.integers(1, 8)) for _ in range(draw.integers(0, 6))]
        codes = np.concatenate([np.zeros(0, dtype=np.int64), *parts])
        got = list(zip(*(c.tolist() for c in find_runs(codes, len(codes) // 4))))
        assert got == brute_runs(codes.tolist()), trial


def test_report_agrees_with_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(5)
    word = lambda: ["Der", "der", "café", "x", " ", "汉字"][draw.integers(6)]
    texts = [None, "", " \t\n", "a", "a a a a a a", "a a a a a", "b a a a a a a b b a b a b a b a", "x\x0by\x0cx y x y x\ty x"]
    texts += [" ".join(word() for _ in range(draw.integers(1, 300))) for _ in range(150)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "a b " * 9), (7, texts[7]), (2 ** 60 + 1, "q " * 1500)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, runs int, n_words string")
    got = run_report(docs.repartition(3))
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((brute_report(*r) for r in rows), key=key)
    assert run_report(docs.limit(0)).count() == 0


def test_long_text_and_rules(spark):
    """A text beyond a batch is searched whole; planting touches one id in ten."""
    n = periodic.BATCH_WORDS + 50_000
    text = " ".join(f"w{k}" for k in range(n - 40_000)) + " " + "a b c d " * 10_000
    r = word_runs(spark.createDataFrame([(1, text), (2, "z " * 300_000)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(x) for x in r[0].runs] == [(n - 40_000, 40_000, 4)] and len(r[0].collapsed.split()) == n - 40_000 + 4
    assert [tuple(x) for x in r[1].runs] == [(0, 300_000, 1)] and r[1].collapsed == "z"
    changed = [k for k in range(1000) if planted_places(zlib.crc32(str(k).encode()), 50) is not None]
    assert all(zlib.crc32(str(k).encode()) % 10 == 0 for k in changed) and changed
