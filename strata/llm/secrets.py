"""Secrets in whole texts, in DataFrame functions alone (operator 1).

Base rules find assigned secrets, access keys and hex strings. Besides them, two
character Markov models, one of random strings and one of ordinary identifiers,
judge every token of 16 characters or more of the secrets' alphabet that no base span
touches, whatever mix of letters, digits and signs it is: a token whose log-likelihood
ratio reaches ``least_ratio`` becomes a span of kind ``random``.

The models are fitted on labelled samples: by default the strings the base rules
find (random) and the tokens of 8 to 15 characters outside of them, with their digits,
signs and capitals (ordinary), from all documents. The
counts combine before the shuffle, come to the driver as at most 128 x 128 x 2 numbers and go back as one array of rounded ratios, so scores are
whole numbers.

Positions come from the pieces between matches: no row is multiplied and
nothing is shuffled but the counts. They are code points, ends exclusive.

Defined cases: a null text counts as empty and has no spans; texts are taken
whole, with any number of spans; repeated rows are judged each; without samples
no ``random`` span is found; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import PREFIX, running_sum

KINDS = ("assign", "access", "hex", "random")  # in the order of spans that begin together

# The base rules.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LEAST_VALUE = 12  # characters of an assigned value

BASE = f"{ASSIGN}|{ACCESS}|{HEX}"
TOKEN = "[A-Za-z0-9+/_=-]{16,}"  # what the models judge, unless a base span covers some of it
# What the ordinary model learns from: shorter tokens of the same alphabet, so that no token
# that is judged, however often it is repeated, has taught that it is ordinary.
IDENTIFIER = "[A-Za-z0-9+/_=-]{8,}"
LONGEST_LEARNED = 15


@dataclass(frozen=True)
class SecretSettings:
    smoothing: float = 0.5
    symbols: int = 64  # of the tokens' alphabet
    least_ratio: int = 8000  # thousandths of a natural logarithm


def _matches(text: Column, pattern: str) -> Column:
    none = F.array().cast("array<string>")
    return F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)


def _gaps(text: Column, pattern: str, matches: Column) -> Column:
    """Lengths of the pieces before, between and after the matches."""
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    return F.when(F.size(matches) > 0, pieces).otherwise(F.array().cast("array<bigint>"))


def _spans(steps: Column, matches: Column, kind: str) -> Column:
    """(start, rank, end, kind, value) of each match; a step is a gap with the match after it."""
    rank = KINDS.index(kind)
    ends = F.slice(running_sum(steps), 2, F.size(matches))
    spans = F.zip_with(
        ends,
        matches,
        lambda e, m: F.struct(
            (e - F.length(m)).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), F.lit(kind).alias("kind"),
            m.alias("value"),
        ),
    )
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>")
    return F.when(F.size(matches) > 0, spans).otherwise(empty)


def _found(df: DataFrame, text: Column, pattern: str, kind: str) -> DataFrame:
    """Adds column ``_strata_<kind>``, the spans of a pattern; steps apart, so that each scan runs once."""
    matches, steps = f"{PREFIX}m_{kind}", f"{PREFIX}s_{kind}"
    df = df.withColumn(matches, _matches(text, pattern))
    gaps = F.slice(_gaps(text, pattern, F.col(matches)), 1, F.size(matches))
    df = df.withColumn(steps, F.zip_with(gaps, F.col(matches), lambda g, m: g + F.length(m)))
    return df.withColumn(f"{PREFIX}{kind}", _spans(F.col(steps), F.col(matches), kind)).drop(matches, steps)


def base_spans(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``_strata_assign``, ``_strata_access`` and ``_strata_hex``."""
    df = _found(df, text, ASSIGN, "assign")
    long_enough = F.filter(
        F.col(f"{PREFIX}assign"), lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 2)) >= LEAST_VALUE
    )
    df = df.withColumn(f"{PREFIX}assign", long_enough)
    return _found(_found(df, text, ACCESS, "access"), text, HEX, "hex")


def labelled_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, is_random): strings of the base rules, and the identifiers outside of them, of all documents."""
    texts = docs.select(docs[text_col].alias("text")).where("text IS NOT NULL")
    values = F.transform(_matches(F.col("text"), ASSIGN), lambda x: F.regexp_extract(x, ASSIGN, 2))
    random = F.concat(
        F.filter(values, lambda x: F.length(x) >= LEAST_VALUE), _matches(F.col("text"), ACCESS), _matches(F.col("text"), HEX)
    )
    tokens = F.regexp_extract_all(F.regexp_replace("text", BASE, " "), F.lit(IDENTIFIER), F.lit(0))
    ordinary = F.filter(tokens, lambda x: F.length(x) <= LONGEST_LEARNED)
    return texts.select(F.explode(random).alias("token"), F.lit(True).alias("is_random")).unionByName(
        texts.select(F.explode(ordinary).alias("token"), F.lit(False).alias("is_random"))
    )


def _characters(token: Column) -> Column:
    """Character codes of a blank and the token; split at once, as cutting out each one walks the token anew."""
    return F.transform(F.split(F.concat(F.lit(" "), token), ""), lambda c: F.ascii(c))


def _side_by_side(codes: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``make`` of each character and the next one."""
    return F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), make)


def train(samples: DataFrame, settings: SecretSettings = SecretSettings()) -> list[int] | None:
    """128 x 128 rounded log-likelihood ratios of one character after another; None without both labels.

    A token's first character follows a blank.
    """
    s = settings
    known = samples.where("length(token) > 0").select("is_random", _characters(F.col("token")).alias("codes"))
    pairs = known.select(
        "is_random",
        F.inline(_side_by_side(F.col("codes"), lambda a, b: F.struct(a.alias("a"), b.alias("b")))),
    )
    counts = pairs.groupBy("is_random", "a", "b").count()
    rows = counts.where("a < 128 AND b < 128").collect()  # two labels of 128 x 128 pairs at most
    if len({r["is_random"] for r in rows}) < 2:
        return None
    seen = {(r["is_random"], r["a"], r["b"]): r["count"] for r in rows}
    before: dict[tuple[bool, int], int] = {}
    for (label, a, _), n in seen.items():
        before[label, a] = before.get((label, a), 0) + n

    def share(label: bool, a: int, b: int) -> float:
        return (seen.get((label, a, b), 0) + s.smoothing) / (before.get((label, a), 0) + s.smoothing * s.symbols)

    return [round(1000 * math.log(share(True, a, b) / share(False, a, b))) for a in range(128) for b in range(128)]


def _ratio(token: Column, table: list[int]) -> Column:
    """The token's log-likelihood ratio in thousandths."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")

    def total(codes: Column) -> Column:
        each = _side_by_side(codes, lambda a, b: F.get(ratios, a * 128 + b))
        return F.aggregate(each, F.lit(0).cast("long"), lambda acc, x: acc + x)

    # a one-element array binds the codes, so that they are made once
    return F.get(F.transform(F.array(_characters(token)), total), F.lit(0))


def find_secrets(
    docs: DataFrame, text_col: str = "text", table: list[int] | None = None, settings: SecretSettings = SecretSettings()
) -> DataFrame:
    """``docs`` with ``_strata_base`` and ``_strata_spans``: arrays of (start, rank, end, kind, value) by start, then kind.

    ``table`` comes from ``train``; without it there are base spans only.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    df = base_spans(docs, text)
    kinds = [F.col(f"{PREFIX}{kind}") for kind in KINDS[:3]]
    df = df.withColumn(f"{PREFIX}base", F.sort_array(F.concat(*kinds)))
    if table is None:
        return df.withColumn(f"{PREFIX}spans", F.col(f"{PREFIX}base")).drop(*[f"{PREFIX}{kind}" for kind in KINDS[:3]])
    df = _found(df, text, TOKEN, "random")
    judged = F.filter(
        F.col(f"{PREFIX}random"),
        lambda x: ~F.exists(F.col(f"{PREFIX}base"), lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"]))
        & (_ratio(x["value"], table) >= settings.least_ratio),
    )
    df = df.withColumn(f"{PREFIX}random", F.when(F.size(f"{PREFIX}random") > 0, judged).otherwise(F.col(f"{PREFIX}random")))
    spans = F.sort_array(F.concat(f"{PREFIX}base", f"{PREFIX}random"))
    return df.withColumn(f"{PREFIX}spans", spans).drop(*[f"{PREFIX}{kind}" for kind in KINDS])


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
