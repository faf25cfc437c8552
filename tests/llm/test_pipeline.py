"""Stages of the pipeline against plain loops over a small table."""

import re
from collections import Counter

from pyspark.sql import functions as F
from test_operators import jaccard_brute

import corpus_pipeline
from tidemark.llm import language_id, pii


def texts():
    base = [" ".join(f"word{k}x{i}" for i in range(60)) for k in range(6)]
    rows = []
    for k, text in enumerate(base):
        rows += [(10 * k, text), (10 * k + 1, text + " tail"), (10 * k + 2, f"other{k} " * 3 + " ".join(text.split()[:30]))]
    rows += [(3, base[0]), (3, base[1] + " x"), (None, base[2]), (None, base[2]), (None, "a text of its own without any id at all"),
             (70, base[0]), (70, base[0]), (71, "short"), (72, "short")]
    return rows


def test_copies_go_by_id_and_text(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    distinct = sorted(set(rows), key=repr)
    found = jaccard_brute({i: t for i, (_, t) in enumerate(distinct)}, 5, 4, 5)
    groups = {}
    for i, (_, root) in found.items():
        groups.setdefault(root, []).append(distinct[i])
    assert set(got.values()) == {1} and len(got) == len(groups)
    for members in groups.values():
        kept = [m for m in members if m in got]
        least = min((m[0] is None, m[0] or 0) for m in members)
        assert len(kept) == 1 and (kept[0][0] is None, kept[0][0] or 0) == least


def test_language_and_masking_stages(spark, docs):
    rows = docs.select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.detect_language(spark, rows, "")
    lettered = Counter((r.doc_id, r.text) for r in rows.collect() if re.search(r"[^\W\d_]", r.text or ""))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == lettered
    masked = corpus_pipeline.mask_personal_data(spark, rows, "")
    judged = {r.text: r.m for r in rows.select("text", pii.redact(F.col("text")).alias("m")).collect()}
    assert Counter((r.doc_id, r.text, r.n_chars) for r in masked.collect()) == Counter(
        (r.doc_id, judged[r.text], None if r.text is None else len(judged[r.text])) for r in rows.collect()
    )
    assert language_id.UNKNOWN == "und"


def test_empty_table_and_further_columns(spark, docs):
    more = docs.withColumn("__x", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, more.limit(0), "").count() == 0, name
    assert corpus_pipeline.pack_sequences(spark, more.limit(0), "").count() == 0
    assert "__x" in corpus_pipeline.drop_near_copies(spark, more, "").columns
