"""Language of a text by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed subwords (letter n-grams that know where a word begins and ends); a
linear layer and a softmax make probabilities of it. Both are trained together by stochastic gradient descent on a
bounded sample. A held back part of the sample calibrates the probabilities (one temperature) and sets the levels at
which an answer is rejected: its probability is too low, or the subwords of the text are too surprising for the answer.
A softmax shares out all probability among what it knows, so only the second tells a language that was never learned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed
from .shared import from_text

BUCKETS = 1 << 14
GRAMS = (1, 2, 3)
UNKNOWN = "und"
PER_LANGUAGE = 1500       # labelled texts of a language that are learned from, at most
MAX_TEXTS = 8_000         # of all languages together, evenly, but at least one each; a text is at most BUCKETS pairs of numbers
BESIDE = 64               # a text is judged as if so many typical subwords stood beside it: few subwords prove little
WEIGHT = 1000             # subwords a text counts for in its language's frequencies, at most
SLACK = 0.5               # excess surprise that is never held against a text: quantiles of few held back texts are too tight
LOST = 0.005              # share of held back texts with the right answer beyond each level
_STEP = 1 << 20           # letters handled at once

_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters; one table per worker."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def subword_counts(text: str) -> np.ndarray | None:
    """How often each bucket's subwords occur in a whole text; None if it has no letter.

    Upper and lower case are one; whatever is no letter ends a word. Very long texts are handled in steps that overlap,
    so that no subword is lost or counted twice.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    good = _letters()[codes]
    if not good.any():
        return None
    codes = np.concatenate([[0], np.where(good, codes, 0), [0]]).astype(np.uint64)
    counts = np.zeros(BUCKETS, np.int64)
    widest = max(GRAMS)
    for at in range(0, len(codes), _STEP):
        part = codes[at:at + _STEP + widest - 1]
        border = part == 0
        last = min(_STEP, len(part))              # n-grams that begin in this step
        for n in GRAMS:
            if len(part) < n:
                continue
            m = min(last, len(part) - n + 1)
            h = np.full(m, 0x9E3779B97F4A7C15 + n, np.uint64)
            inside = ~(border[:m] & border[n - 1:n - 1 + m])
            for i in range(n):
                h = (h ^ part[i:i + m]) * np.uint64(0x100000001B3)
                h ^= h >> np.uint64(29)
                if 0 < i < n - 1:
                    inside &= ~border[i:i + m]     # a border may only be at either end
            counts += np.bincount((h[inside] >> np.uint64(7)) & np.uint64(BUCKETS - 1), minlength=BUCKETS)
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray          # embeddings times the linear layer: bucket -> scores
    bias: np.ndarray
    temperature: float
    least: float               # scores below are rejected
    surprise: np.ndarray       # bucket -> minus log frequency in each language, less the mean of the language
    most: np.ndarray           # by language: texts of more excess surprise are rejected

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        """One row per text."""
        x = counts / counts.sum(1, keepdims=True)
        logits = (x @ self.table + self.bias) / self.temperature
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def excess(self, counts: np.ndarray) -> np.ndarray:
        """Excess surprise a subword in each language, one row per text; about 0 for texts of the language."""
        return counts @ self.surprise / (counts.sum(1, keepdims=True) + BESIDE)

    def rejects(self, language: int, score: float, excess: float) -> bool:
        return bool(score < self.least or excess > self.most[language])


def share_drawn(draw: Column, wanted: Column, n: Column) -> Column:
    """Whether a hash of 64 bits falls into the share ``wanted`` of ``n``: as a fraction, which no size rounds to nothing.

    Twice the share and a few more, so that hardly any draw is short of ``wanted``; a rank takes away what is too much.
    """
    return F.shiftrightunsigned(draw, 1).cast("double") / F.lit(float(1 << 63)) < (2 * wanted + 8) / n.cast("double")


def labelled_sample(df: DataFrame, allowed: Column, id_col: str, text: str, label: str, per_language: int) -> pd.DataFrame:
    """Subword counts of at most ``per_language`` texts of each label, drawn by a hash of id and text.

    Every label that has a row is learned: ``MAX_TEXTS`` is shared out evenly, with one text each at least. Counts per
    label say which share of its rows to draw; a task turns drawn texts into sparse counts, so what reaches the driver is
    bounded by the number of texts times the number of buckets, however long the texts are.
    """
    known = df.filter(allowed & F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.xxhash64(F.col(id_col).cast("string"), F.col(text).cast("string")).alias("draw"),
        F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"))
    sizes = checkpointed(known.groupBy("label").agg(F.count("*").alias("n")))
    wanted = min(per_language, max(1, MAX_TEXTS // max(1, sizes.count())))

    def answer(texts: list) -> list[list]:
        counts = [c if (c := subword_counts(t)) is not None else np.zeros(BUCKETS, np.int64) for t in texts]
        at = [np.flatnonzero(c) for c in counts]
        return [[a.astype("<u2").tobytes() for a in at], [c[a].astype("<f4").tobytes() for a, c in zip(at, counts)]]

    # repeated rows share a draw and count once, so that they cannot swell it; ranks are over the few rows drawn
    drawn = known.join(sizes, "label").filter(share_drawn(F.col("draw"), F.lit(wanted), F.col("n"))) \
        .groupBy("label", "draw").agg(F.first("text").alias("text"))
    counted = from_text(drawn, "text", "at binary, n binary", lambda: answer, 128).filter(F.octet_length("at") > 0)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("draw"))
    sample = counted.withColumn("rank", rank).filter(F.col("rank") <= wanted).select("label", "draw", "at", "n").toPandas()
    return sample.sort_values(["draw", "label"], kind="stable", ignore_index=True)


def trained(sample: pd.DataFrame, width: int = 16, epochs: int = 12, rate: float = 0.5, seed: int = 5,
            lost: float = LOST) -> LanguageModel | None:
    """Model from sparse counts; None without any. A fifth of the sample is held back for calibration.

    The temperature has the least loss against targets that stay short of certainty, by the rule of succession: n texts
    told right prove (n + 1) / (n + 2). The levels come from held back texts with the right answer. ``least`` is the
    ``lost`` quantile of their scores, but never nearer to certainty than to a guess. ``most`` lies midway between the
    1 - ``lost`` quantile of their excess in their own language and the ``lost`` quantile of their least excess in any
    other one, which is how a language looks that was not learned (where there is no other: subwords no better than
    guessed). A language whose own texts spread further has its own quantile, one without a held back text no level.
    """
    if not len(sample):
        return None
    rng = np.random.default_rng(seed)
    languages = sorted(set(sample["label"]))
    y = sample["label"].map({v: i for i, v in enumerate(languages)}).to_numpy()
    rows = [(np.frombuffer(a, "<u2"), np.frombuffer(n, "<f4")) for a, n in zip(sample["at"], sample["n"])]
    sizes = np.array([n.sum() for _, n in rows], np.float64)
    rows = [(a, n / n.sum()) for a, n in rows]
    order = rng.permutation(len(rows))
    first = np.zeros(len(rows), bool)                      # one text of each language is never held back
    first[order[np.unique(y[order], return_index=True)[1]]] = True
    held, rest = np.split(order[~first[order]], [len(rows) // 5])
    used = np.concatenate([order[first[order]], rest])
    embedding = rng.normal(0, 1 / np.sqrt(width), (BUCKETS, width)).astype(np.float32)
    layer = np.zeros((width, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, step = epochs * len(used), 0
    for _ in range(epochs):
        for i in rng.permutation(used):
            at, n = rows[i]
            now = rate * (1 - step / steps)
            mean = n @ embedding[at]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1                                   # gradient of the softmax
            back = layer @ p
            layer -= now * np.outer(mean, p)
            bias -= now * p
            embedding[at] -= (now * len(at) ** 0.5) * np.outer(n, back)
            step += 1
    often = np.full((BUCKETS, len(languages)), 0.5)
    for i in used:
        at, n = rows[i]
        often[at, y[i]] += n * min(sizes[i], WEIGHT)
    often /= often.sum(0)
    surprise = -np.log(often)
    surprise -= (often * surprise).sum(0)
    model = LanguageModel(languages, (embedding @ layer).astype(np.float64), bias.astype(np.float64), 1.0, 0.0,
                          surprise, np.full(len(languages), np.inf))
    if not len(held):
        return model
    logits = np.array([n @ model.table[at] + model.bias for at, n in (rows[i] for i in held)])
    truth = y[held]
    sure = (len(held) + 1) / (len(held) + 2)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        logs = z - np.log(np.exp(z).sum(1, keepdims=True))
        own = logs[np.arange(len(z)), truth]
        return float(-np.mean(sure * own + (1 - sure) / (len(languages) - 1) * (logs.sum(1) - own)))

    if len(languages) > 1:
        model.temperature = float(min(np.geomspace(0.02, 50, 120), key=loss))
    z = logits / model.temperature
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    right = p.argmax(1) == truth
    if not right.any():
        return model
    if len(languages) > 1:
        model.least = float(min((1 + 1 / len(languages)) / 2, np.quantile(p.max(1)[right], lost)))
    excess = np.array([n @ surprise[at] * sizes[i] / (sizes[i] + BESIDE) for i in held[right] for at, n in [rows[i]]])
    kind = truth[right]
    own = excess[np.arange(len(kind)), kind]
    if len(languages) > 1:
        excess[np.arange(len(kind)), kind] = np.inf
        foreign = np.quantile(excess.min(1), lost)
    else:
        foreign = np.log(BUCKETS) + (often * np.log(often)).sum()
    inside = np.quantile(own, 1 - lost)
    level = (inside + max(inside, foreign)) / 2
    for k in np.unique(kind):
        model.most[k] = max(SLACK, level, np.quantile(own[kind == k], 1 - lost))
    return model


def predicted(df: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``rejected`` in place of its text.

    A null text, one without a letter, or no model at all: ``und`` with score 0, rejected. The whole text counts; nothing
    but the text is looked at.
    """
    def answer(texts: list) -> list[list]:
        names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        found = [(i, c) for i, t in enumerate(texts) if t and (c := subword_counts(t)) is not None] if model else []
        if found:
            counts = np.stack([c for _, c in found]).astype(np.float64)
            for (i, _), row, excess in zip(found, model.probabilities(counts), model.excess(counts)):
                k = int(row.argmax())
                names[i], scores[i] = model.languages[k], float(row[k])
                rejected[i] = model.rejects(k, scores[i], excess[k])
        return [names, scores, rejected]

    return from_text(df, text, "lang_pred string, score double, rejected boolean", lambda: answer, 128)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identified(df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """Learn from labelled rows that are not held out, then answer every row: the id, ``held_out``, ``lang_pred``, ``score``,
    ``rejected``. Null ids are never held out; ids may be repeated; the result has a row for each row.
    """
    model = trained(labelled_sample(df, ~held_out(id_col), id_col, text, label, per_language))
    rows = df.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text).alias("text"))
    return predicted(rows, model).withColumnRenamed("id", id_col)


def accepted(df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows of ``df`` whose language is not rejected, with all their columns; ``lang`` is left as it is."""
    model = trained(labelled_sample(df, ~held_out(id_col), id_col, text, label, per_language))
    marked = predicted(df.select(F.struct("*").alias("whole"), F.col(text).alias("text")), model)
    return marked.filter("not rejected").select("whole.*")
