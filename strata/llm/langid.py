"""Language identification by averaged hashed subword embeddings (operator 5).

A text's features are its byte n-grams within words (a blank stands for a word's
edge), hashed to ``buckets``. The hidden state is the average of their embeddings,
and a linear softmax on it gives the languages. Embeddings and softmax are
trained together by stochastic gradient descent in numpy, on whole texts and on
random stretches of them, so that short texts are known too.

As everything after the average is linear, prediction needs one table
(buckets x languages): the product of embeddings and softmax. Whole texts are
scored, in one pass and without a shuffle.

The model is fitted on a bounded sample: ``sample_rows`` texts of each language, the
first by a hash of the id, in ``sample_bytes`` / number of languages bytes. If they
need more, the longest are cut to a stretch at a random place, all to the same
bytes, ``least_bytes`` at least; no text is left out for its length. A fifth of it, as whole texts and as stretches of
all lengths, sets the temperature that makes scores honest and the score below
which a text is rejected. That bar is measured for each length, by the number of
n-grams: in log-odds, it lies ``margin`` of the way from the score that all but
``reject_share`` of the rightly labelled texts reach down to mere chance.

Defined cases: a null text or one without a letter gives ``und``, score 0, and is
rejected; so does every text if nothing could be learned. Rows without id or
language are never learned from. An empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

UNKNOWN = "und"


@dataclass(frozen=True)
class LangSettings:
    orders: tuple[int, ...] = (1, 2, 3, 4)  # bytes in an n-gram
    bucket_bits: int = 15
    width: int = 16
    epochs: int = 6
    stretches: int = 3  # of each text in each epoch
    rate: float = 0.5
    sample_rows: int = 800  # for each language
    sample_bytes: int = 24 << 20  # for all languages together
    least_bytes: int = 400  # of each text, whatever the number of languages
    reject_share: float = 0.001
    margin: float = 0.5  # of the way from that score to chance
    bar_texts: int = 200  # a bar is measured on, at least
    seed: int = 11


_LETTERS = np.zeros(256, dtype=np.uint8) + 32
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def letters(text: str) -> np.ndarray:
    """Lower-cased bytes; everything but letters is a blank, with one at both ends."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    out = np.full(len(raw) + 2, 32, dtype=np.uint8)
    out[1:-1] = _LETTERS[raw]
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def features(data: np.ndarray, s: LangSettings) -> np.ndarray:
    """Buckets of all n-grams that hold a letter and have blanks at their ends alone."""
    found = []
    wide = data.astype(np.uint32)
    blank = data == 32
    for n in s.orders:
        size = len(data) - n + 1
        if size <= 0:
            continue
        code = wide[:size].copy()
        for i in range(1, n):
            code |= wide[i : i + size] << np.uint32(8 * i)
        use = ~blank[:size] if n < 3 else np.ones(size, dtype=bool)
        if n == 2:
            use = ~(blank[:size] & blank[1 : 1 + size])
        for i in range(1, n - 1):
            use &= ~blank[i : i + size]
        code = code[use] * np.uint32(2654435761) + np.uint32(n * 0x9E3779B1 % 2**32)
        code ^= code >> np.uint32(15)
        found.append((code * np.uint32(2246822519)) >> np.uint32(32 - s.bucket_bits))
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint32)


@dataclass(frozen=True)
class LangModel:
    langs: tuple[str, ...]
    scores: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float
    bars: tuple[np.ndarray, np.ndarray]  # lengths, as logarithms of n-grams; scores below are rejected
    settings: LangSettings

    def logits(self, found: np.ndarray) -> np.ndarray:
        if not len(found):
            return self.bias
        if len(found) > len(self.scores) // 4:
            return np.bincount(found, minlength=len(self.scores)) @ self.scores / len(found) + self.bias
        return self.scores[found].sum(axis=0) / len(found) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected) of one whole text."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        found = features(letters(text), self.settings)
        p = _softmax(self.logits(found) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] < np.interp(np.log2(len(found) + 1), *self.bars))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def _stretch(data: np.ndarray, random: np.random.Generator, length: int = 0) -> np.ndarray:
    """A run of ``length`` bytes, or else of 10 to 400, cut at blanks where there are some."""
    length = length or int(10 * 40 ** random.random())
    if len(data) <= length:
        return data
    start = int(random.integers(0, len(data) - length))
    part = data[start : start + length]
    edges = np.flatnonzero(part == 32)
    return part[edges[0] : edges[-1] + 1] if len(edges) > 2 else part


def _bars(sizes: np.ndarray, scores: np.ndarray, langs: int, s: LangSettings) -> tuple[np.ndarray, np.ndarray]:
    """The rejection bar at each length, from the scores of rightly labelled texts."""
    if langs < 2 or not len(scores):
        return np.zeros(1), np.zeros(1)
    chance = -np.log(langs - 1)
    odds = np.log(scores) - np.log(np.maximum(1 - scores, 1e-15))
    at = np.arange(int(sizes.min()), int(sizes.max()) + 2)
    bars = []
    for size in at:
        far = np.abs(sizes - size)
        near = far <= max(0.5, np.sort(far)[min(len(far), s.bar_texts) - 1])
        bars.append(np.quantile(odds[near], s.reject_share))
    return at.astype(float), 1 / (1 + np.exp(-(s.margin * chance + (1 - s.margin) * np.array(bars))))


def fit(texts: list[str], labels: list[str], s: LangSettings = LangSettings()) -> LangModel:
    """Train on labelled texts, the last fifth of them kept for calibration."""
    pairs = [(letters(t), lang) for t, lang in zip(texts, labels, strict=True) if has_letter(t)]
    langs = tuple(sorted({lang for _, lang in pairs}))
    buckets = 1 << s.bucket_bits
    if not langs:
        return LangModel((), np.zeros((buckets, 1)), np.zeros(1), 1.0, _bars(np.empty(0), np.empty(0), 0, s), s)
    random = np.random.default_rng(s.seed)
    at = {lang: i for i, lang in enumerate(langs)}
    order = random.permutation(len(pairs))
    held = set(order[: len(pairs) // 5].tolist()) if len(pairs) >= 20 else set()
    train = [p for i, p in enumerate(pairs) if i not in held]
    calibration = [pairs[i] for i in sorted(held)] or train
    embed = random.uniform(-1, 1, (buckets, s.width)) / s.width
    soft = random.uniform(-1, 1, (s.width, len(langs))) / s.width
    bias = np.zeros(len(langs))
    total, step = s.epochs * len(train) * (s.stretches + 1), 0
    for _ in range(s.epochs):
        for i in random.permutation(len(train)):
            data, lang = train[i]
            for part in [data] + [_stretch(data, random) for _ in range(s.stretches)]:
                rate = s.rate * (1 - step / total)
                step += 1
                found, times = np.unique(features(part, s), return_counts=True)
                if not len(found):
                    continue
                weight = times / times.sum()
                hidden = weight @ embed[found]
                error = _softmax(hidden @ soft + bias)
                error[at[lang]] -= 1
                back = soft @ error
                soft -= rate * np.outer(hidden, error)
                bias -= 0.1 * rate * error
                embed[found] -= (rate * min(len(found), 50)) * np.outer(weight, back)
    model = LangModel(langs, embed @ soft, bias, 1.0, _bars(np.empty(0), np.empty(0), 0, s), s)
    lengths = [8 << i for i in range(10) for _ in range(2)]
    parts = calibration + [(_stretch(d, random, n), lang) for d, lang in calibration for n in lengths if len(d) > n]
    logits, sizes = np.empty((len(parts), len(langs))), np.empty(len(parts))
    for i, (part, _) in enumerate(parts):
        found = features(part, s)
        logits[i], sizes[i] = model.logits(found), np.log2(len(found) + 1)
    right = np.array([at[lang] for _, lang in parts])

    def scored(t: float) -> np.ndarray:
        x = logits / t
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def loss(t: float) -> float:
        return float(-np.log(scored(t)[np.arange(len(right)), right] + 1e-12).mean())

    temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    p = scored(temperature)
    sure = p.argmax(axis=1) == right
    bars = _bars(sizes[sure], p.max(axis=1)[sure], len(langs), s)
    return LangModel(langs, model.scores, bias, float(temperature), bars, s)


def _share(sizes: pd.Series, budget: int) -> int:
    """The bytes to which the longest texts are cut, so that all keep within the budget together."""
    ordered = np.sort(sizes.to_numpy())
    for i, size in enumerate(ordered):
        share = max(0, budget) // (len(ordered) - i)
        if size > share:
            return int(share)
        budget -= int(size)
    return int(ordered[-1])


def train(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    settings: LangSettings = LangSettings(),
) -> LangModel:
    """Fit on the bounded sample of ``labelled``; ids and languages are picked before any text is fetched."""
    s = settings
    rows = labelled.select(
        labelled[id_col].alias("id"), labelled[text_col].alias("text"), labelled[lang_col].cast("string").alias("lang")
    ).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.groupBy("lang").count().collect()
    langs = {r["lang"]: r["count"] for r in counts}
    if not langs:
        return fit([], [], s)
    whole = 1_000_000_007
    bars = F.create_map(*[F.lit(x) for lang, n in langs.items() for x in (lang, min(whole, 4 * s.sample_rows * whole // n))])
    first = Window.partitionBy("lang").orderBy("draw", "id")
    draw = F.pmod(F.xxhash64(F.lit(s.seed), "id"), F.lit(whole))
    sized = rows.select("id", "lang", draw.alias("draw"), F.octet_length("text").alias("size"))
    picked = (  # a draw that lets some four times as many pass keeps the ranking small at any size
        sized.where(F.col("draw") <= F.try_element_at(bars, F.col("lang")))
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= s.sample_rows)
        .select("id", "lang", "size")
        .toPandas()
    )
    budget = s.sample_bytes // len(langs)
    shares = {lang: max(s.least_bytes, _share(sizes, budget)) for lang, sizes in picked.groupby("lang")["size"]}
    spark = labelled.sparkSession
    ids = spark.createDataFrame([(i,) for i in picked["id"].unique().tolist()], rows.select("id").schema)
    share = F.try_element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang"))
    chars, size = F.length("text"), F.octet_length("text")
    length = F.floor(chars * F.least(F.lit(1.0), share / size)).cast("int")
    start = F.pmod(F.xxhash64(F.lit(s.seed), F.lit("start"), "id"), chars - length + 1).cast("int") + 1
    sample = rows.join(F.broadcast(ids), "id").select(
        "id", "lang", F.when(size > share, F.substring("text", start, length)).otherwise(F.col("text")).alias("text")
    )
    sample = sample.dropDuplicates(["id"]).toPandas()
    sample = sample.sort_values("id")
    return fit(sample["text"].tolist(), sample["lang"].tolist(), s)


def predicted(docs: DataFrame, text: Column, model: LangModel) -> Column:
    """A struct (lang, score, rejected) of a text column."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(
        T.StructType().add("lang", T.StringType()).add("score", T.DoubleType()).add("rejected", T.BooleanType())
    )
    def predict(texts: pd.Series) -> pd.DataFrame:
        model = sent.value
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score", "rejected"])

    return predict(text)


def held_out(id_column: Column) -> Column:
    """True for the rows no model learns from: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_known(docs: DataFrame, model: LangModel, text_col: str = "text") -> DataFrame:
    """The rows whose language is not rejected, all columns as they are."""
    return docs.where(~predicted(docs, docs[text_col], model)["rejected"])
