"""Positions of pattern matches, as column expressions only.

``regexp_extract_all`` returns the leftmost non-overlapping matches and
``split`` on the same pattern the gaps between them; their lengths give every
start and end in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.shared import let

_BLOCK = 256
CONTEXT = 40


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def running_before(values: Column) -> Column:
    """Sum of all earlier elements, per element of an array of longs.

    Elements are summed within blocks of 256 and over the blocks before, so the
    work stays far below the square of the number of matches in long texts.
    """
    def with_values(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: _total(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK))))
        starts = F.aggregate(
            sums,
            F.array(F.lit(0).cast("bigint")),
            lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s)),
        )

        def with_starts(s: Column) -> Column:
            def before(_: Column, i: Column) -> Column:
                block = F.floor(i / _BLOCK).cast("int")
                return F.get(s, block) + _total(F.slice(v, block * _BLOCK + 1, i % _BLOCK))

            return F.transform(v, before)

        return let(starts, with_starts)

    return F.when(F.size(values) > 0, let(values, with_values)).otherwise(
        F.array().cast("array<bigint>")
    )


def _parted(text: Column, pattern: str, body) -> Column:
    """``body`` of the matches and the gaps; a text without match is searched only once."""
    def with_hits(t: Column, hits: Column) -> Column:
        gaps = F.when(F.size(hits) > 0, F.split(t, pattern, -1)).otherwise(F.array(t))
        return let(F.struct(hits.alias("hits"), gaps.alias("gaps")), body)

    return let(
        text,
        lambda t: let(
            F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda hits: with_hits(t, hits)
        ),
    )


def find(text: Column, pattern: str) -> Column:
    """All matches: ``start``, ``end`` (exclusive), ``value``, ``before``, ``after``.

    ``before`` and ``after`` hold up to 40 code points of the gaps beside a
    match. The pattern must not match the empty string. NULL counts as empty.
    """
    text = F.coalesce(text, F.lit(""))

    def located(parts: Column) -> Column:
        hits, gaps = parts["hits"], parts["gaps"]
        steps = F.zip_with(
            hits, F.slice(gaps, F.lit(1), F.size(hits)),
            lambda h, g: (F.char_length(h) + F.char_length(g)).cast("bigint"),
        )

        def placed(base: Column) -> Column:
            def one(hit: Column, i: Column) -> Column:
                start = F.get(base, i) + F.char_length(F.get(gaps, i))
                return F.struct(
                    start.alias("start"),
                    (start + F.char_length(hit)).alias("end"),
                    hit.alias("value"),
                    F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
                    F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after"),
                )

            return F.transform(hits, one)

        return let(running_before(steps), placed)

    return _parted(text, pattern, located)


def rewrite(text: Column, pattern: str, replacement) -> Column:
    """``text`` with every match replaced by ``replacement(value, before, after)``, in linear work."""

    def joined(parts: Column) -> Column:
        hits, gaps = parts["hits"], parts["gaps"]
        pieces = F.transform(
            gaps,
            lambda gap, i: F.concat(
                gap,
                F.coalesce(
                    F.when(
                        i < F.size(hits),
                        replacement(
                            F.get(hits, i),
                            F.right(gap, F.lit(CONTEXT)),
                            F.left(F.get(gaps, i + 1), F.lit(CONTEXT)),
                        ),
                    ),
                    F.lit(""),
                ),
            ),
        )
        return F.array_join(pieces, "")

    return _parted(text, pattern, joined)


def tagged(found: Column, kind: str, rank: int, score: Column | None = None) -> Column:
    """Matches as ``(rank, kind, start, end, score)``, ready to be put in order."""
    return F.transform(
        found,
        lambda m: F.struct(
            F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            m["start"].alias("start"), m["end"].alias("end"),
            (m["score"] if score is None else score).alias("score"),
        ),
    )


def listed(spans: Column, by_start: bool) -> Column:
    """``kind:start:end`` joined with commas, by start then rank or by rank then start."""
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            *((s["start"], s["rank"]) if by_start else (s["rank"], s["start"])),
            s["end"].alias("e"),
            F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")).alias("t"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda k: k["t"]), ",")
