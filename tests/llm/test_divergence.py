"""Divergence audit against plain loops, in one tile and in several, with odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence


def brute(rows, top=200, least=3):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    found = []
    for lang, source in groups:
        kept = [t for t, n in held[lang].items() if n >= least]
        mine = [s for g, s in groups if g == lang]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in mine}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 1) // (total[s] + len(kept)) for t in kept} for s in mine}
        whole = {t: sum(counts[lang, s][t] for s in mine) for t in kept}
        q = {t: 1 + 10**9 * (whole[t] + 1) // (sum(whole.values()) + len(kept)) for t in kept}
        pairs = [(sum((p[source][t] - p[s][t]) ** 2 // p[s][t] for t in kept), s) for s in mine if s != source]
        leading = [((p[source][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, source][t] and p[source][t] > q[t]]
        for part, items, limit in (("pair", pairs, None), ("term", leading, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            found += [(lang, source, part, t, v, i + 1) for i, (v, t) in enumerate(items[:limit])]
    return sorted(found)


def rows_of():
    rng = np.random.default_rng(2)
    words = [f"{a}{b}{c}" for a in "abcdé" for b in ("x", "Y", "ß") for c in ("", "q", "語", "zz")]
    weight = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(300):
        source = None if i % 17 == 0 else f"s{i % 7}"
        lang = (None, "de", "en")[i % 3]
        some = rng.choice(words, rng.integers(0, 25), p=np.roll(weight, i % 7) / weight.sum())
        rows.append((" ".join(some) + ("" if i % 4 else " 12, Ä-b"), lang, source))
    rows += [(None, "de", "s1"), ("", "it", "a"), ("uno due", "it", "b"), ("123", "it", None), ("alone", "fr", "x"),
             (rows[1][0], rows[1][1], rows[1][2]), ("lang " * 400_000, "en", "s3")]
    return rows


@pytest.mark.parametrize("top, tile", [(200, 512), (4, 2)])
def test_against_plain_loops(spark, monkeypatch, top, tile):
    monkeypatch.setattr(divergence, "WAITING", 10)
    monkeypatch.setattr(divergence, "PART", 50)
    monkeypatch.setattr(divergence, "FLUSH", 40)
    rows = rows_of()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    docs = docs.withColumns({c: F.lit("x") for c in ("term", "n", "p", "total", "block")})
    got = sorted(map(tuple, divergence.audit(docs, top=top, tile=tile).collect()))
    assert got == brute(rows, top)


def test_odd_rows_and_empty_table(docs):
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert sorted(map(tuple, divergence.report(docs).collect())) == brute(rows)
    assert divergence.report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("k", [1, 3, 200])
def test_skyband(k):
    rng = np.random.default_rng(k)
    high, low = rng.integers(0, 30, 2_000), rng.integers(0, 30, 2_000)
    name = rng.permutation(2_000)
    kept = set(divergence.skyband(name, high, low, k).tolist())
    better = (high[:, None] >= high) & (low[:, None] <= low) & (name[:, None] < name)
    assert kept == set(np.flatnonzero(better.sum(axis=0) < k).tolist())


def test_shares_of_large_counts(spark):
    n, total = 7 * 10**12, 9 * 10**12 + 5
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 1) // total
