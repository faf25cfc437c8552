"""Personal data: patterns propose, checksums confirm, context words adjust the score.

Spans of the four base kinds that pass their check always stay. The method adds
two kinds: ``iban`` (mod-97) and ``ssn``, which has no checksum and therefore
needs a context word to reach the threshold.

Defined cases: NULL text is empty and has no span; repeated rows give repeated
results; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans

_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"

# Possessive repeats and a start only where a run begins (or the last match
# ended) find the same matches as the plain patterns, in linear time.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")

#: Words near a match that speak for its kind.
CONTEXT_WORDS = {
    "email": "e-?mail|contact|write|address",
    "ip": "ip|server|host|address|network",
    "card": "card|credit|debit|visa|master|payment|amex",
    "phone": "phone|call|tel|mobile|fax|contact",
    "iban": "iban|bank|account|konto|cuenta|compte",
    "ssn": "ssn|social|security|insurance",
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.7, "ssn": 0.3}
CONTEXT_GAIN = 0.25
THRESHOLD = 0.5


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True when a string of digits passes the Luhn check."""
    def weighed(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).otherwise(n * 2 - F.when(n > 4, 9).otherwise(0))

    figures = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    return F.aggregate(F.transform(figures, weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(value: Column) -> Column:
    """True when an IBAN leaves the remainder 1."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    """The check of a kind on a matched string."""
    count = F.char_length(digits_of(value))
    if kind == "ip":
        return F.regexp_like(
            value, F.lit(r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)){3}$")
        )
    if kind == "card":
        return count.between(16, 19) & luhn(digits_of(value))
    if kind == "phone":
        return count.between(8, 15)
    return mod97(value) if kind == "iban" else F.lit(True)


def score(kind: str, before: Column, after: Column) -> Column:
    """Prior of the kind, raised by a context word within 40 code points."""
    near = F.lit(rf"(?i)\b(?:{CONTEXT_WORDS[kind]})")
    helped = F.regexp_like(before, near) | F.regexp_like(after, near)
    return F.least(F.lit(PRIOR[kind]) + F.when(helped, CONTEXT_GAIN).otherwise(0.0), F.lit(1.0))


def accepted(kind: str, value: Column, before: Column, after: Column) -> Column:
    """Confirmed and, for an added kind, above the threshold."""
    sure = confirmed(kind, value)
    return sure if kind in BASE else sure & (score(kind, before, after) >= THRESHOLD)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and, per kind, an array of ``start, end, value, score``."""
    def of(kind: str) -> Column:
        kept = F.filter(
            spans.find(F.col(text_col), PATTERNS[kind]),
            lambda m: accepted(kind, m["value"], m["before"], m["after"]),
        )
        return F.transform(
            kept,
            lambda m: F.struct(
                m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
                score(kind, m["before"], m["after"]).alias("score"),
            ),
        )

    return docs.select(F.col(id_col), *[of(k).alias(k) for k in PATTERNS])


def redact(text: Column) -> Column:
    """``text`` with every accepted match replaced by its kind in angle brackets.

    Kinds are rewritten one after the other, so overlapping matches of two
    kinds vanish as well. NULL stays NULL.
    """
    given = text
    for kind in PATTERNS:
        text = spans.rewrite(
            text, PATTERNS[kind],
            lambda v, b, a, k=kind: F.when(accepted(k, v, b, a), F.lit(f"<{k.upper()}>")).otherwise(v),
        )
    return F.when(given.isNotNull(), text)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts, digest of the base spans, all spans."""
    found = detect(docs)
    tagged = [spans.tagged(F.col(k), k, i) for i, k in enumerate(PATTERNS)]
    both = found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.concat(*tagged[: len(BASE)]).alias("base"),
        F.concat(*tagged[len(BASE):]).alias("added"),
    )
    return both.select(
        "doc_id", *[f"n_{k}" for k in BASE],
        F.sha2(spans.listed(F.col("base"), by_start=False), 256).alias("base_sha256"),
        spans.listed(F.concat("base", "added"), by_start=False).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )

