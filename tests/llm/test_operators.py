"""Odd cases of every operator, and brute-force counterparts on a small fixture."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    fingerprints, jaccard_join, language_id, licences, mixing, packing, pii, secrets, topk_search, warc_archive,
)

REPORTS = [fingerprints, jaccard_join, language_id, licences, mixing, packing, pii, secrets]


@pytest.mark.parametrize("module", REPORTS, ids=lambda m: m.__name__.rpartition(".")[2])
def test_odd_rows_and_empty_table(docs, module):
    found = module.report(docs).collect()
    ids = Counter(r.doc_id for r in found)
    if module is not packing:
        assert ids == Counter(r.doc_id for r in docs.collect())
    else:
        assert ids.keys() == {r.doc_id for r in docs.collect()}
    assert module.report(docs.limit(0)).count() == 0


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_pii_base_spans(docs):
    rows = {r.doc_id: r for r in pii.report(docs.where("doc_id = 6")).collect()}
    text = docs.where("doc_id = 6").first().text
    spans = [
        (kind, text.index(value), text.index(value) + len(value))
        for kind, value in (("email", "a.b@example.com"), ("ip", "10.0.0.1"),
                            ("card", "4111 1111 1111 1111"), ("phone", "+49 170 1234567"))
    ]
    assert rows[6].base_sha256 == digest(spans)
    masked = docs.select(pii.redact(F.col("text")).alias("t")).where("t is not null").collect()
    assert not any("4111" in r.t or "@" in r.t or "10.0.0.1" in r.t for r in masked)


def test_pii_checks(spark):
    texts = ["4111 1111 1111 1112", "300.1.1.1", "007.0.0.255", "DE89 3704 0044 0532 0130 00 bank",
             "ssn 123-45-6789", "123-45-6789", "a@b.c_d@e.f", "1 " * 30_000]
    found = [r.spans for r in pii.report(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert found == ["", "", "ip:0:11", "iban:0:27", "ssn:4:15", "", "email:0:5,email:5:11", ""]


def test_secrets_base_and_random(spark):
    random = "".join(np.random.default_rng(1).choice(list("ABCDEFGHabcdefgh0123456789xyzXYZ+/"), 60))
    texts = ["api_key: " + "a" * 11, "Secret:api_key=abcdefghijkl", "x" + "AKIA" + "A" * 13, "key " + random,
             "internationalizationofeverything"]
    rows = secrets.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_assign for r in rows] == [0, 1, 0, 0, 0]
    assert [r.n_access for r in rows] == [0] * 5
    assert rows[3].n_random == 1 and rows[4].n_random == 0


def test_mixing_targets_and_reruns(docs):
    first, again = (sorted(map(tuple, mixing.report(docs).collect()), key=str) for _ in range(2))
    assert first == again
    rows = mixing.report(docs).join(docs.select("doc_id", "source").distinct(), "doc_id").collect()
    assert all(r.taken <= 3 * r.size for r in rows)
    texts = mixing.repeated(docs).select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert texts == sum(r[4] for r in first)


def test_packing_round_trip(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    single = docs.dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in single.collect()}
    pieces = packing.report(single).collect()
    held = Counter()
    for p in pieces:
        ids = tokenizer.encode(texts[p.doc_id], add_special_tokens=False).ids + [1]
        assert p.doc_tokens == len(ids)
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
        held[p.sequence_id] += p.length
    assert sum(held.values()) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    assert max(held.values()) <= packing.CAPACITY


def test_patterns_meet_demand():
    rng = np.random.default_rng(0)
    demand = {int(s): int(n) for s, n in zip(range(1, 257), rng.integers(0, 500, 256))}
    solved = packing.solve(demand, 256)
    supplied = Counter()
    for pattern, times in solved:
        assert sum(s * n for s, n in pattern.items()) <= 256
        for s, n in pattern.items():
            supplied[s] += n * times
    assert supplied == Counter({s: n for s, n in demand.items() if n})
    used, least = sum(t for _, t in solved), sum(s * n for s, n in demand.items()) / 256
    assert used <= least * 1.02 + 10


def jaccard_brute(texts, n, num, den):
    sets = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if i < j and common and den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("n, num, den, block", [(3, 9, 10, 1 << 18), (5, 4, 5, 200), (2, 1, 2, 120)])
def test_jaccard_join(spark, monkeypatch, n, num, den, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = np.random.default_rng(n)
    base = [[f"w{x}" for x in rng.integers(0, 400, 60)] for _ in range(6)]
    texts = {}
    for i in range(80):
        words = list(base[i % 6])
        for at in rng.integers(0, 60, rng.integers(0, 4)):
            words[at] = f"v{rng.integers(0, 9)}"
        texts[i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(frame, n, num, den).collect()}
    assert got == jaccard_brute(texts, n, num, den)


def test_fingerprints_follow_ids(docs):
    rows = {r.doc_id: r for r in fingerprints.report(docs.where("doc_id <> 1")).collect()}
    assert rows[2].fingerprint == rows[3].fingerprint and rows[2].near_next == 1.0
    first, following = docs.where("doc_id = 0").first().text, ""
    edited = first[: len(first) - len(first) // 2] + following
    assert rows[0].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_language_held_out(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.report(documents).join(documents.select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_unknown(docs):
    named = {r.doc_id: r.lang_pred for r in language_id.report(docs).collect()}
    assert {named[i] for i in (2, 3, 4, 8)} == {"und"}


def test_language_sample_is_bounded(spark):
    known = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, "few").otherwise("many").alias("lang"))
    limits = language_id.draw_limits(known, "doc_id", 1_000)
    taken = {
        lang: known.where((F.col("lang") == lang) & (language_id.draw_bin(F.col("doc_id")) >= least)).count()
        for lang, least in limits.items()
    }
    assert taken["few"] == 300 and 950 < taken["many"] <= 1_000


def test_topk_odd_vectors(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i % 7).normal(size=64)]) for i in range(205)]
    rows += [(300, None), (400, []), (500, [float("nan")] * 64), (None, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk_search.report(frame).collect()
    assert {r.query_id for r in found} == {0, 100, 200, 500}
    nearest = sorted((r.position, r.neighbour_id, r.distance) for r in found if r.query_id == 100)
    assert nearest == [(k + 1, i, 0) for k, i in enumerate(range(2, 72, 7))]
    assert topk_search.report(frame.limit(0)).count() == 0


def test_warc_round_trip(spark):
    rows = [(3, "u", "same"), (1, "v\r\n", "same"), (2, None, None), (5, "w", ""), (1, "v", "same"), (None, "n", "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    found = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc_archive.report(pages).collect()), key=str)
    assert found == sorted([
        (3, "revisit", 1, 4), (1, "response", None, 4), (1, "response", None, 4), (2, "response", None, 0),
        (5, "revisit", 2, 0), (None, "response", None, 100_000),
    ], key=str)
    assert warc_archive.report(pages.limit(0)).count() == 0


def test_pipeline_stages(spark, docs):
    rows = docs.select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, "")
        assert rows.columns == list(corpus_pipeline.COLUMNS)
    assert 1 not in {r.doc_id for r in rows.collect()}
    assert corpus_pipeline.pack_sequences(spark, rows, "").count() > 0
