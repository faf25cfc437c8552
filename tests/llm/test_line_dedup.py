"""Line dedup against a plain loop, on both ways of dropping, with odd rows."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup

SPACE = "\x20\t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows):
    """Sorted (id, lines, dropped, kept text) of (id, text) rows."""
    holders = defaultdict(set)
    for r, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            holders[key(line)].add(r)
    found = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            k = key(line)
            ids = [rows[r][0] for r in holders[k] if rows[r][0] is not None]
            goes = len(k) >= 20 and len(holders[k]) >= 3 and ids and doc_id != max(ids)
            kept += [] if goes else [line]
        found.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


def rows_of():
    rng = np.random.default_rng(5)
    pool = [f"  Shared Line number {i} of the TABLE\t" for i in range(12)] + [
        "kurz", "ÄÖÜ" + "é" * 17, "é" * 19, "ab" * 10, "ab" * 9 + "c", "x" * 70_000, "\x0bDer ÜBLICHE Hinweis am Ende\x0c", "",
    ]
    rows = [(int(i), "\n".join(pool[k].upper() if rng.random() < 0.3 else pool[k] for k in rng.integers(0, len(pool), rng.integers(0, 9)))
             + f"\nown words of document {i} alone") for i in range(60)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, None), (61, None), (62, ""), (63, "\n\n")]
    rows += [(None, "only nameless documents hold this line")] * 3
    rows += [(64, "twice in one document, and so\nTWICE in one document, and so \n")]
    return rows


@pytest.mark.parametrize("held", [line_dedup.HELD, 0])
def test_against_plain_loop(spark, held):
    rows = rows_of()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.withColumn("row", F.lit("x")).withColumn("n_lines", F.lit("x")).withColumn("digests", F.lit(1))
    found = line_dedup.dedup(docs, held=held)
    assert found.columns == ["doc_id", "text", "row", "digests", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in found.collect()), key=repr)
    assert got == brute(rows)
    assert found.where("text is null").count() == 2


def test_report_and_empty_table(docs):
    found = {r.doc_id: r for r in line_dedup.report(docs).collect()}
    assert found[2].n_lines == 1 and found[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert line_dedup.report(docs.limit(0)).count() == 0


def test_full_filter_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAP_BITS", 14)
    monkeypatch.setattr(line_dedup, "FLUSH", 500)
    rows = [(i, "\n".join(f"line {k} of all the many lines" for k in range(i, i + 40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.dedup(docs).collect()), key=repr)
    assert got == brute(rows)


def test_filter_covers_what_is_seen_twice(spark):
    texts = spark.createDataFrame([("the same line of text here",), ("The same line of text here ",), ("another line of text here",)],
                                  "text string").repartition(3)
    bits = 20
    again = line_dedup.seen_twice(texts, bits, 20)
    met = list(line_dedup._suspects([b"the same line of text here", b"another line of text here"], again, bits, 20))
    assert [row for row, *_ in met] == [0]
