"""Line-first cleaning and document quality, in DataFrame functions alone (operator 3).

Every line is judged by rules of its own:

* punctuation: a line of ``least_words`` words or more without an end mark, unless
  it looks like a heading or a list item; or one where marks and symbols make up
  more than ``most_marks`` of its characters;
* navigation: a short line of menu words, or of parts held apart by bars;
* boilerplate: notices that sites add to every page.

Failing lines go. A document goes if it fails the base rules (too few words, too
much repetition) or if the lines removed held more than ``most_lost`` of its word
characters. All counts are made in the row: there is no shuffle. Repeated
word windows are found by sorting their hashes with their places, so a long text
costs n log n.

Defined cases: a null or blank text has no words and fails; texts are taken whole;
repeated rows are judged each; an empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import PREFIX

WORDS = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
END_MARK = "[.!?:;,…。！？][\"')”’»\\]]*[\\x20\\x09-\\x0D]*$"
HEADING = "^[\\x20\\x09-\\x0D]*([-*#0-9•]|[^a-z]*$)"
MARKS = "[!?#*$%&|<>={}~^_@+]"

# Words of menus, and notices.
MENU = (
    "home|menu|login|log in|sign in|sign up|register|next|previous|prev|back to top|skip to content|site map|sitemap"
    "|contact us|about us|read more|click here|search|share|tweet|print"
)
NAVIGATION = f"(?i)^[^a-z]*(({MENU})([^a-z]+|$))+$"
BARS = "[|»›>]"
BOILERPLATE = (
    "(?i)all rights reserved|cookie policy|we use cookies|privacy policy|terms of (use|service)|enable javascript"
    "|subscribe to our newsletter|powered by wordpress|lorem ipsum"
)


@dataclass(frozen=True)
class QualitySettings:
    fewest_words: int = 50  # of a document
    most_repeated: int = 50  # percent of words in repeated windows
    window: int = 3
    least_words: int = 5  # of a line that must have an end mark
    most_marks: float = 0.15
    menu_words: int = 12  # at most, of a line of menu words
    words_a_bar: int = 6  # at most, in a line of parts held apart by bars
    most_lost: float = 0.4


def line_fails(line: Column, n_words: Column, s: QualitySettings = QualitySettings()) -> Column:
    """True for a line that one of the rules removes; a line without words stays."""
    marks = F.length(line) - F.length(F.regexp_replace(line, MARKS, ""))
    unended = (n_words >= s.least_words) & ~line.rlike(END_MARK) & ~line.rlike(HEADING)
    marked = marks > F.length(line) * s.most_marks
    bars = F.length(line) - F.length(F.regexp_replace(line, BARS, ""))
    menu = ((n_words <= s.menu_words) & line.rlike(NAVIGATION)) | ((bars >= 2) & (bars * s.words_a_bar >= n_words))
    return (n_words > 0) & (marked | unended | menu | line.rlike(BOILERPLATE))


def _windows(codes: Column, window: int) -> Column:
    """Hashes of an array's windows, in order. ``codes`` must be a column: it is read for each place."""
    last = F.size(codes) - window
    grams = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(codes, i + k) for k in range(window)]))
    return F.when(last >= 0, grams).otherwise(F.array().cast("array<bigint>"))


def _covered(grams: Column, window: int) -> Column:
    """Words covered by the windows whose hash occurs more than once."""
    sorted_grams = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def places(rows: Column) -> Column:
        twice = F.filter(
            rows,
            lambda x, k: (x["g"] == F.get(rows, k - 1)["g"]).eqNullSafe(F.lit(True))
            | (x["g"] == F.get(rows, k + 1)["g"]).eqNullSafe(F.lit(True)),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def total(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("end")),
            lambda acc, at: F.struct(
                (acc["n"] + at + window - F.greatest(at, acc["end"])).cast("long").alias("n"),
                (at + window).cast("int").alias("end"),
            ),
            lambda acc: acc["n"],
        )

    # each step is bound by a one-element array, so that it is evaluated once
    bound = F.transform(F.array(sorted_grams), places)
    return F.get(F.transform(bound, total), F.lit(0))


def quality(docs: DataFrame, text_col: str = "text", settings: QualitySettings = QualitySettings()) -> DataFrame:
    """``docs`` with ``_strata_quality``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    clean (the text without failing lines), lost (share of word characters removed), kept."""
    s = settings
    text, lines, words, grams = (F.col(f"{PREFIX}{c}") for c in ("text", "lines", "words", "grams"))
    df = docs.withColumn(f"{PREFIX}text", F.coalesce(docs[text_col], F.lit("")))
    df = df.withColumn(f"{PREFIX}words", F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)))
    df = df.withColumn(f"{PREFIX}lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORDS)))
    df = df.withColumn(f"{PREFIX}codes", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn(f"{PREFIX}grams", _windows(F.col(f"{PREFIX}codes"), s.window))
    counted = F.transform(
        lines, lambda x: F.struct(x.alias("line"), F.size(F.regexp_extract_all(x, F.lit(WORDS), F.lit(0))).alias("n"))
    )
    good = F.filter(counted, lambda x: ~line_fails(x["line"], x["n"], s))
    clean = F.array_join(F.transform(good, lambda x: x["line"]), "\n")
    repeated = F.when(F.size(F.array_distinct(grams)) < F.size(grams), _covered(grams, s.window)).otherwise(F.lit(0))

    def word_chars(value: Column) -> Column:
        return F.length(F.regexp_replace(value, r"[\x20\x09-\x0D]+", "")).cast("long")

    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated.cast("long"),
        "clean": clean,
    }
    df = df.withColumn(f"{PREFIX}counts", F.struct(*[c.alias(n) for n, c in counts.items()]))
    c = F.col(f"{PREFIX}counts")
    base_failed = (c["n_words"] < s.fewest_words) | (100 * c["n_repeat_words"] > s.most_repeated * c["n_words"])
    lost = F.when(c["word_chars"] > 0, 1 - word_chars(c["clean"]) / c["word_chars"]).otherwise(F.lit(0.0))
    df = df.withColumn(f"{PREFIX}lost", lost)
    whole = F.struct(
        *[c[n].alias(n) for n in counts],
        base_failed.alias("base_failed"),
        F.col(f"{PREFIX}lost").alias("lost"),
        (~base_failed & (F.col(f"{PREFIX}lost") <= s.most_lost)).alias("kept"),
    )
    helpers = [f"{PREFIX}{n}" for n in ("text", "lines", "words", "codes", "grams", "counts", "lost")]
    return df.withColumn(f"{PREFIX}quality", whole).drop(*helpers)


def clean_documents(docs: DataFrame, text_col: str = "text", settings: QualitySettings = QualitySettings()) -> DataFrame:
    """The kept documents with their failing lines removed, every other column as it is."""
    found = quality(docs, text_col, settings).where(F.col(f"{PREFIX}quality.kept"))
    return found.withColumn(text_col, F.col(f"{PREFIX}quality.clean")).select(*docs.columns)
