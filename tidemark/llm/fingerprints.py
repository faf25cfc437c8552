"""MinHash fingerprints of documents, and near-duplicate classes by shared shingles.

A fingerprint holds the minima of 128 universal hash permutations over the
five-word shingles of a text, 32 bits each, as hexadecimal text. The share of equal
minima estimates the Jaccard similarity.

Classes join texts by verified links of Jaccard 0.8 or more. Candidates share one of the
signature's 32 bands of 4 minima: every node of a band is linked to the smallest one
met so far, one link per node and band, and Jaccard is verified within the components.
A pair at 0.8 shares no band with a probability of 5e-8. ``near_classes`` takes exact
prefixes as candidates instead, for who wants every link whatever its cost.

``edits`` needs the next document by id without a sort of all texts in one task:
ids are dealt to ranges whose bounds are fixed beforehand, the first document of
every range is also handed to the range before, and each range is read in order.

Defined cases: NULL text is empty; an empty shingle set has the largest value in
all places, so empty texts equal one another; NULL ids come after all others;
repeated ids follow one another in the order of their texts' hashes; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.jaccard_join import (
    class_names, classes, named_classes, named_text, one_per_node, profiled, set_id, slices,
)
from tidemark.llm.prefix_tree import Similar
from tidemark.llm.shared import Scratch, give_back, shuffle_partitions, sparing
from tidemark.llm.shingles import mix, shingle_hashes, shingle_set, word_hashes
from tidemark.session import stage

PERMUTATIONS = 128
SHINGLE = 5
SIMILAR = Similar(4, 5)
BANDS = 32
#: Class names that are broadcast (32 MB); beyond it the fingerprints are shuffled to them.
NAMES = 1 << 21
_BLOCK = 1 << 9
#: Pairs of band and node that a task merges at a time; a range of bands holds about as many.
_MERGED = 1 << 20
_random = np.random.default_rng(20240)
_A = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64)


def signature(text: str | None) -> np.ndarray:
    """128 minima of ``(a x + b mod 2^64) >> 32``."""
    x = shingle_hashes(word_hashes(text), SHINGLE)
    least = np.full(PERMUTATIONS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(x), _BLOCK):
        block = np.multiply.outer(x[at : at + _BLOCK], _A)
        block += _B
        np.minimum(least, block.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(">u4")


def bands(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a signature."""
    parts = least.astype(np.uint64).reshape(BANDS, -1)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(parts.shape[1]):
        keys = mix(keys * _A[0] + parts[:, i])
    return keys


def band_links(docs: DataFrame, count: int) -> DataFrame:
    """``a, b``: links that join all nodes of each band, from ``doc_id, text`` of ``count`` nodes.

    Bands travel as packed arrays, one row per batch and hash range. A range is merged
    piece by piece with the smallest node of each band so far, so a band of
    any number of nodes takes bounded memory.
    """
    ranged = max(5, (BANDS * count // _MERGED).bit_length())
    sent = pa.schema([("range", pa.int32()), ("packed", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pairs = [np.zeros((0, 2), np.int64)]
            for text in batch.column(1).to_pylist():
                elements = shingle_set(text, SHINGLE)
                if len(elements):
                    keys = bands(signature(text)).view(np.int64)
                    pairs.append(np.column_stack((keys, np.full(BANDS, set_id(elements)))))
            both = np.concatenate(pairs)
            number = both[:, 0].view(np.uint64) >> np.uint64(64 - ranged)
            order = np.argsort(number, kind="stable")
            both, number = np.ascontiguousarray(both[order]), number[order]
            cuts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else number
            ends = [*cuts[1:], len(number)]
            yield pa.RecordBatch.from_arrays([
                pa.array(number[cuts].astype(np.int32)), pa.array([both[x:y].tobytes() for x, y in zip(cuts, ends)], pa.binary()),
            ], schema=sent)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, waiting, size = np.zeros((0, 2), np.int64), [], 0

        def merged() -> tuple[np.ndarray, pa.RecordBatch]:
            both = np.concatenate((known, *waiting))
            both = both[np.lexsort((both[:, 1], both[:, 0]))]
            first = np.concatenate(([True], both[1:, 0] != both[:-1, 0])) if len(both) else np.zeros(0, bool)
            least = both[first]
            target = least[np.cumsum(first) - 1, 1]
            apart = both[:, 1] != target
            links = np.unique(np.column_stack((both[apart, 1], target[apart])), axis=0)
            return least, pa.RecordBatch.from_arrays(
                [pa.array(links[:, 0]), pa.array(links[:, 1])], schema=pa.schema([("a", pa.int64()), ("b", pa.int64())])
            )

        for batch in batches:
            for part in batch.column("packed").to_pylist():
                waiting.append(np.frombuffer(part, np.int64).reshape(-1, 2))
                size += len(waiting[-1])
                if size >= _MERGED:
                    known, found = merged()
                    waiting, size = [], 0
                    yield found
        yield merged()[1]
        give_back()

    packed = docs.mapInArrow(sparing(pack), "range int, packed binary")
    return packed.groupBy("range").applyInArrow(link, "a long, b long").distinct()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first ones of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


def _ordered(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """``docs`` with ``range``, and the first row of every range again, at the end of the one before."""
    spark = docs.sparkSession
    wanted = shuffle_partitions(spark) * per_partition
    marks = sorted(set(docs.approxQuantile("doc_id", [i / wanted for i in range(1, wanted)], 0.25 / wanted)))
    bounds = F.array(*[F.lit(int(m)) for m in marks]).cast("array<bigint>")
    number = F.when(F.col("doc_id").isNull(), len(marks) + 1).otherwise(
        F.size(F.filter(bounds, lambda m: m <= F.col("doc_id")))
    ).cast("int")
    ranged = docs.withColumn("range", number).withColumn("last", F.lit(False))
    # One row per range: its first id, and the range before it (the last one before the first).
    firsts = ranged.groupBy("range").agg(F.min("doc_id").alias("first_id"))
    before = F.lag("range").over(Window.orderBy("range"))
    top = F.max("range").over(Window.partitionBy())
    heads, _ = stage(firsts.select("first_id", F.col("range").alias("own"), F.coalesce(before, top).alias("to")), "heads")
    copies = (
        ranged.join(F.broadcast(heads), (F.col("range") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
        .withColumn("h", F.xxhash64("text"))
    )
    single = copies.groupBy("own").agg(F.min_by(F.struct("doc_id", "text", "to"), "h").alias("d"))
    tails = single.select("d.doc_id", "d.text", F.col("d.to").alias("range"), F.lit(True).alias("last"))
    return ranged.unionByName(tails)


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("node", pa.int64()),
])


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and how near they and the next text are."""
    return _written(_edits(named_text(docs, id_col, text_col))).drop("node")


def _written(found: DataFrame) -> DataFrame:
    """Fingerprints as hexadecimal text."""
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def _edits(named: DataFrame) -> DataFrame:
    """:func:`edits` of ``doc_id, text`` in bytes, and the shingle set as ``node``."""
    packed = pa.schema([("range", pa.int32()), ("doc_id", pa.int64()), ("h", pa.int64()), ("last", pa.bool_()), ("text", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts compressed one by one: the shuffle moves and stores half as much."""
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [press(t or b"") for t in batch.column(4).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(texts, pa.binary())], schema=packed)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # range, doc_id, text, signature
        plain = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for part, doc, _, last, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                text = plain(text).decode("utf-8", "surrogatepass")
                own = signature(text)
                if held is not None and held[0] == part:
                    rows.append(_row(held, text, own))
                held = None if last else (part, doc, text, own)
            columns = zip(*rows) if rows else [[] for _ in RESULT]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)

    def _row(held: tuple, following: str, next_signature: np.ndarray) -> tuple:
        _, doc, text, own = held
        new = edited(text, following)
        changed = own if new == text else signature(new)
        digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        return (
            doc, len(text), digest, own.tobytes(), changed.tobytes(), likeness(own, changed), likeness(own, next_signature),
            set_id(shingle_set(text, SHINGLE)),
        )

    ranged = _ordered(named).select("range", "doc_id", F.xxhash64("text").alias("h"), "last", "text")
    small = ranged.mapInArrow(sparing(pack), "range int, doc_id long, h long, last boolean, text binary")
    spread = small.repartition(shuffle_partitions(named.sparkSession), "range")
    in_order = spread.sortWithinPartitions("range", "last", F.col("doc_id").asc_nulls_last(), "h")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, node long"
    return in_order.mapInArrow(sparing(compare), schema)


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents joined by verified links of Jaccard 0.8 or more."""
    return classes(*named_classes(named_text(docs, id_col, text_col), SHINGLE, SIMILAR))


def band_classes(docs: DataFrame) -> DataFrame:
    """``node, component`` of ``doc_id, text``: classes of verified links between texts that share a band."""
    scratch = Scratch()
    _, nodes = profiled(docs, SHINGLE, scratch, keep=False)
    single = one_per_node(docs, nodes)
    links = scratch(band_links(single, nodes.count()), "band-links")
    names = class_names(docs, nodes, links, SHINGLE, SIMILAR, scratch)
    scratch.clear()
    return names


def report(docs: DataFrame) -> DataFrame:
    """:func:`edits`, with the smallest id of each document's class as ``class_id``.

    Rows meet their class by shingle set, so texts that share an id, or have none,
    are told apart.
    """
    docs = named_text(docs, "doc_id", "text")
    known = band_classes(docs)
    # The names are few and narrow beside the fingerprints; they are broadcast up to a checked number.
    if known.count() <= NAMES:
        known = F.broadcast(known)
    named = _written(_edits(docs).join(known, "node", "left"))
    return named.withColumn("class_id", F.coalesce("component", "doc_id")).drop("node", "component")
