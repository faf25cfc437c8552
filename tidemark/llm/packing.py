"""Packing documents into sequences by cutting-stock column generation.

A document is its token ids and an end id. Every full capacity of a document is
a sequence of its own; what is left is shorter than a sequence and is rounded up
to a class of ``GRAIN`` tokens. The histogram of classes (at most 256 numbers) goes
to the driver, where a linear program over patterns is solved: the simplex method
holds one pattern per class, and a knapsack prices the next pattern. Patterns are
rounded down, the rest is filled largest first, so every piece has its slot.

Pieces are ranked within their class by the task that made them and their order
in it; ranks need one count per class and task, not a sort. A pattern's copies
claim ranges of ranks, and a join on the class finds each piece's sequence.

Defined cases: NULL and empty texts are the end id alone; repeated rows are packed
each for itself; NULL ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

CAPACITY = 2048
END_ID = 1
GRAIN = 8
#: Words whose ids a task remembers; the store starts anew beyond it.
REMEMBERED = 400_000
#: White-space characters in a row from which on a text is encoded by the library.
LONG_SPACE = 1 << 16
#: The linear program may stop this close to its bound.
GAP = 1e-4

PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("class", pa.int32()), ("task", pa.int64()), ("rank", pa.int64()),
])
_PIECE_SQL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, task long, rank long"
)


class TokenBytes:
    """Little-endian 32-bit ids of texts.

    The pattern that parts a text before the merges never crosses from a
    character that is no white space into a following space, so a text may be
    cut there and its words, which repeat, be encoded once per process. The ids are
    those of the vocabulary file, merged by rank (the rank of a merge is its id). The
    file's added tokens are cut out first and have their own ids; what lies between
    two of them is a text of its own.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self._encode = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(path), special_tokens={}
        ).encode_ordinary
        self._path, self._library = path, None
        self._spaced = re.compile(r"\s ")
        self._long = re.compile(rf"\s{{{LONG_SPACE}}}")
        self._added = {t: np.array([i], "<u4").tobytes() for t, i in _added(path).items()}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._parts = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self._added else None
        self._known: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self._encode(text), "<u4").tobytes()

    def _between(self, text: str) -> bytes:
        """Ids of a text without added tokens.

        The fast encoder's stack overflows on runs of several hundred thousand white-space
        characters; texts with a long run go to the library itself.
        """
        if len(text) >= LONG_SPACE and self._long.search(text):
            return self._by_library(text)
        if self._spaced.search(text):
            return self._plain(text)
        known = self._known
        first, *words = text.split(" ")
        for word in words:
            if word not in known:
                known[word] = self._plain(" " + word)
        return self._plain(first) + b"".join([known[word] for word in words])

    def _by_library(self, text: str) -> bytes:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        return np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        for text in texts:
            parts = self._parts.split(text or "") if self._parts else [text or ""]
            # Every second part is an added token.
            yield b"".join([self._added[p] if i % 2 else self._between(p) for i, p in enumerate(parts)])
            if len(self._known) > REMEMBERED:
                self._known.clear()


def _added(path: str) -> dict[str, int]:
    """Added tokens of a vocabulary file, which are found in a text before anything else is."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens", [])
    for token in tokens:
        if any(token.get(flag) for flag in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"added token {token['content']} takes in or asks for what is beside it")
    return {t["content"]: t["id"] for t in tokens}


def _ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level vocabulary file, without its special tokens.

    Such a file writes a byte as the character of its code if that is visible, and
    the others, in order, as the characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content.get("added_tokens", [])}
    return {bytes(byte_of[c] for c in t): i for t, i in content["model"]["vocab"].items() if t not in special}


_encoders: dict[str, TokenBytes] = {}


def encoder(path: str) -> TokenBytes:
    """One encoder per process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = TokenBytes(path)
    return _encoders[path]


def pieces_of(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int, grain: int) -> DataFrame:
    """One row per piece, with its class (0: a full sequence) and its rank in class and task."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        seen: dict[int, int] = defaultdict(int)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder(path).of(batch.column(1).to_pylist())):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    kind = 0 if length == capacity else -(-length // grain)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc, start, length, crc, total, kind, task, seen[kind]))
                    seen[kind] += 1
            columns = zip(*rows) if rows else [[] for _ in PIECE]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECE)], schema=PIECE)

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(cut, _PIECE_SQL)


def _knapsack(sizes: np.ndarray, values: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes (ascending) within ``units``."""
    best = np.zeros(units + 1)
    choice = np.full(units + 1, -1)
    for room in range(1, units + 1):
        fit = np.searchsorted(sizes, room, side="right")
        best[room] = best[room - 1]
        if fit:
            gain = best[room - sizes[:fit]] + values[:fit]
            top = int(gain.argmax())
            if gain[top] > best[room] + 1e-12:
                best[room], choice[room] = gain[top], top
    counts, room = np.zeros(len(sizes), int), units
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[units]), counts


def solve(demand: dict[int, int], units: int, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """Patterns (size to copies) and how often each is used; demand is met exactly."""
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), int)
    if not len(sizes):
        return []
    wanted = np.array([demand[int(s)] for s in sizes], float)
    patterns = np.diag(units // sizes).astype(float)  # one column per basic pattern
    inverse = np.diag(1.0 / np.diag(patterns))
    used = inverse @ wanted
    for _ in range(40 * len(sizes) + 200):
        price = inverse.sum(axis=0)
        value, column = _knapsack(sizes, np.maximum(price, 0), units)
        if value <= 1 + gap:  # the used sequences divided by this value bound the optimum from below
            break
        along = inverse @ column
        able = np.flatnonzero(along > 1e-9)
        ratio = used[able] / along[able]
        leaves = able[ratio.argmin()]
        step = max(0.0, float(ratio.min()))
        used = np.maximum(used - step * along, 0)
        used[leaves] = step
        pivot = inverse[leaves] / along[leaves]
        inverse -= np.outer(along, pivot)
        inverse[leaves] = pivot
        patterns[:, leaves] = column
    whole = np.floor(used + 1e-9).astype(np.int64)
    supplied = patterns.astype(np.int64) @ whole
    while (supplied > wanted).any():  # only by rounding noise
        over = int(np.flatnonzero(supplied > wanted)[0])
        whole[np.flatnonzero((patterns[over] > 0) & (whole > 0))[0]] -= 1
        supplied = patterns.astype(np.int64) @ whole
    made: dict[tuple, int] = defaultdict(int)
    for at in np.flatnonzero(whole):
        made[tuple(patterns[:, at].astype(int))] += int(whole[at])
    rest = wanted.astype(np.int64) - supplied
    while rest.any():
        room, counts = units, np.zeros(len(sizes), np.int64)
        for at in range(len(sizes) - 1, -1, -1):
            counts[at] = min(rest[at], room // sizes[at])
            room -= counts[at] * sizes[at]
        times = int(min(rest[counts > 0] // counts[counts > 0]))
        made[tuple(counts)] += times
        rest -= counts * times
    return [({int(s): int(n) for s, n in zip(sizes, p) if n}, times) for p, times in sorted(made.items())]


def _slots(solution: list[tuple[dict[int, int], int]], first: int) -> list[tuple[int, int, int, int, int]]:
    """``class, from_rank, to_rank, copies, first_sequence`` of every pattern and class."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], first
    for counts, times in solution:
        for size, copies in counts.items():
            rows.append((size, taken[size], taken[size] + copies * times, copies, sequence))
            taken[size] += copies * times
        sequence += times
    return rows


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    grain: int = GRAIN,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; offsets of a sequence are gapless from 0."""
    spark = docs.sparkSession
    cut, _ = stage(pieces_of(docs, id_col, text_col, path, capacity, grain), "pieces")
    before = F.sum("n").over(Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    counts, _ = stage(
        cut.groupBy("class", "task").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(before, F.lit(0))),
        "piece-counts",
    )
    ranked = cut.join(counts.drop("n"), ["class", "task"]).withColumn("rank", F.col("before") + F.col("rank"))
    demand = dict(counts.groupBy("class").agg(F.sum("n")).collect())  # at most capacity / grain numbers
    full = demand.pop(0, 0)
    slots = spark.createDataFrame(
        _slots(solve(demand, capacity // grain), full),
        "class int, from_rank long, to_rank long, copies long, first long",
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    alone = ranked.where(F.col("class") == 0).select(
        *columns, F.col("rank").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    # Broadcast: patterns times classes, whatever the number of documents.
    shared = ranked.where(F.col("class") > 0).join(
        F.broadcast(slots.withColumnRenamed("class", "slot_class")),
        (F.col("class") == F.col("slot_class"))
        & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")),
    )
    placed = shared.select(
        *columns, "class", "rank",
        (F.col("first") + F.floor((F.col("rank") - F.col("from_rank")) / F.col("copies"))).alias("sequence_id"),
    )
    order = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return alone.unionByName(placed.select(*columns, "sequence_id", F.coalesce(offset, F.lit(0)).alias("offset")))


def report(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
