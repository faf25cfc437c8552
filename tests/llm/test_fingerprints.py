"""Classes of near copies against brute force, on pairs at the limit of 0.8."""

import numpy as np
from test_operators import jaccard_brute

from tidemark.llm import fingerprints


def pairs():
    """Pairs of 196 shingles: 21 changed ones leave a similarity of 0.806, 22 of 0.798."""
    texts = {}
    for k in range(220):
        words = [f"w{k}x{i}" for i in range(200)]
        changed = 21 if k < 200 else 22
        texts[2 * k] = " ".join(words)
        texts[2 * k + 1] = " ".join(words[:-changed] + [f"v{k}x{i}" for i in range(changed)])
    return texts


def test_no_pair_near_the_limit_is_lost(spark):
    texts = pairs()
    want = jaccard_brute(texts, 5, 4, 5)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in fingerprints.near_classes(frame).collect()}
    assert got == want
    assert {r.doc_id: r.class_id for r in fingerprints.report(frame).collect()} == {i: c for i, (_, c) in want.items()}


def test_class_goes_by_text_and_fingerprint_by_minima(spark):
    near = " ".join(f"a{i}" for i in range(100))
    other = " ".join(f"b{i}" for i in range(100))
    rows = [(1, near), (2, near + " end"), (7, other), (7, near), (None, other), (8, None), (None, "")]
    found = fingerprints.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.class_id) for r in found) == sorted([
        ("1", len(near), 1), ("2", len(near) + 4, 1), ("7", len(other), 7), ("7", len(near), 1),
        ("None", len(other), 7), ("8", 0, 8), ("None", 0, None),
    ])
    x = fingerprints.shingle_set(near, 5).tolist()
    least = [min((v * int(a) + int(b)) % 2**64 >> 32 for v in x) for a, b in zip(fingerprints._A, fingerprints._B)]
    written = np.array(least, ">u4").tobytes().hex()
    assert {r.fingerprint for r in found if r.doc_id in (1, 7) and r.class_id == 1} == {written}
