"""What the n-gram Jaccard join gathers before it verifies: no chance meetings, no texts of copies, no shuffle files left."""

import glob

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, shared
from tidemark.llm.jaccard_join import Similar, apart, parity_map


def brute(texts, n, num, den):
    sets = {}
    for i, text in texts.items():
        words = text.split(" ")
        sets[i] = {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if i < j and common and den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    return root


def chained(rng, documents):
    """Each document shares half of its words with the next one; none are similar."""
    parts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 20)) for _ in range(documents + 1)]
    return {i: f"{parts[i]} {parts[i + 1]}" for i in range(documents)}


def joined(spark, texts, n, num, den):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: r.component_id for r in jaccard_join.join(frame, n, num, den).collect()}


def test_shared_passages_make_no_component(spark, monkeypatch):
    texts = chained(np.random.default_rng(4), 150)
    gathered, similar_nodes = [], jaccard_join.similar_nodes

    def noted(docs, nodes, coarse, *rest):
        gathered.append(coarse.count())
        return similar_nodes(docs, nodes, coarse, *rest)

    monkeypatch.setattr(jaccard_join, "similar_nodes", noted)
    assert joined(spark, texts, 3, 4, 5) == {i: i for i in texts}
    assert gathered == [0]


@pytest.mark.parametrize("paired, n, num, den", [(64, 3, 4, 5), (2, 2, 9, 10)])
def test_judged_links_lose_no_similar_pair(spark, monkeypatch, paired, n, num, den):
    """Families of edited texts among texts that share their passages, by plain loops over all pairs."""
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    rng = np.random.default_rng(paired)
    texts = chained(rng, 40)
    for i in range(40, 160):
        words = texts[i % 8].split(" ")
        for at in rng.integers(0, len(words), rng.integers(0, 5)):
            words[at] = f"v{rng.integers(0, 5)}"
        texts[i] = " ".join(words)
    assert joined(spark, texts, n, num, den) == brute(texts, n, num, den)


def test_parity_maps_never_count_too_much():
    rng = np.random.default_rng(0)
    similar = Similar(4, 5)
    for size, changed in ((1, 1), (2, 0), (40, 9), (70, 10), (300, 30), (3000, 400), (70_000, 5000)):
        a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        b = np.unique(np.concatenate((a[changed // 2 :], rng.integers(0, 1 << 64, changed, dtype=np.uint64))))
        found = apart(parity_map(a), parity_map(b))
        assert found == apart(parity_map(b), parity_map(a)) <= len(np.setxor1d(a, b))
        if len(np.intersect1d(a, b)) >= similar.overlap(len(a), len(b)):
            assert found <= len(a) + len(b) - 2 * similar.overlap(len(a), len(b))
    one, other = (np.unique(rng.integers(0, 1 << 64, 400, dtype=np.uint64)) for _ in range(2))
    assert apart(parity_map(one), parity_map(other)) > 800 - 2 * similar.overlap(400, 400)


def test_copies_leave_without_a_shuffle_of_texts(spark, monkeypatch):
    texts = {i: f"some words of text {i % 300} and few others" for i in range(3000)}
    given, frequencies = [], jaccard_join.frequencies

    def noted(docs, *rest):
        given.append((docs.count(), docs._jdf.queryExecution().executedPlan().toString()))
        return frequencies(docs, *rest)

    monkeypatch.setattr(jaccard_join, "frequencies", noted)
    assert joined(spark, texts, 3, 9, 10) == {i: i % 300 for i in texts}
    (count, plan), = given
    assert 300 <= count < 400 and "Exchange" not in plan and "Join" not in plan


def test_removed_shuffle_files(spark):
    """What a query inside has shuffled is gone when it ends; queries outside are left alone."""
    def files():
        root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return sum(len(glob.glob(f"{d}/**/shuffle_*", recursive=True)) for d in root)

    def run():
        before = files()
        spark.range(1000).groupBy(F.col("id") % 7).count().write.format("noop").mode("overwrite").save()
        return files() - before

    with shared.shuffles_removed(spark):
        assert run() <= 0
    assert run() > 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
