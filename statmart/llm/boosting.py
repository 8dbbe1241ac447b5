"""Quality of a document by histogram gradient-boosted trees over its statistics.

One pass over the texts turns each into a row of numbers, and these rows are written; everything after that reads only
them. Trees are grown on a bounded sample of labelled rows: statistics are cut into bins at quantiles, a level of a tree
needs one histogram of gradients per statistic, and a tree stops where no split helps. Rounds that do not help a held back
part of the sample are cut off. The forest is flattened into arrays (statistic, edge, left, right, value), through which
all trees are walked at once, a step for all rows of a batch at a time; leaves lead to themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .shared import from_text

SAMPLE = 40_000           # labelled rows that are learned from, about, drawn by a hash of the id
BINS = 64
ROUNDS = 150
DEPTH = 4
RATE = 0.1
LEAF_WEIGHT = 2.0         # least sum of second derivatives on either side of a split
SHRINK = 1.0              # L2 penalty of a leaf's value
PATIENCE = 20             # rounds without gain on held back rows before growing ends
_STEP = 4096              # rows walked through the trees at once

STATISTICS = [
    "log_chars", "log_words", "log_lines", "letters", "upper_letters", "digits", "blanks", "punctuation", "symbols",
    "beyond_ascii", "char_entropy", "word_length", "word_length_spread", "longest_word", "distinct_words", "commonest_word",
    "repeats_previous", "repeated_triples", "wordless_words", "ends_in_symbol", "line_words", "repeated_lines",
    "lines_ended", "distinct_per_root",
]
SYMBOLS = "#*$%&|<>"      # as in the rules of the quality operator
_LETTER, _UPPER, _DIGIT, _BLANK, _PUNCTUATION, _SYMBOL = (1 << i for i in range(6))
_KINDS: np.ndarray | None = None


def _kinds() -> np.ndarray:
    """What each code point is, as bits; one table per worker."""
    global _KINDS
    if _KINDS is None:
        table = np.zeros(0x110000, np.uint8)
        for bit, test in ((_LETTER, str.isalpha), (_UPPER, str.isupper), (_DIGIT, str.isdigit), (_BLANK, str.isspace)):
            table[np.fromiter((test(chr(c)) for c in range(0x110000)), bool, 0x110000)] |= bit
        table[[ord(c) for c in ".,;:!?\"'()-"]] |= _PUNCTUATION
        table[[ord(c) for c in SYMBOLS]] |= _SYMBOL
        _KINDS = table
    return _KINDS


def _numbered(items: list) -> np.ndarray:
    """Equal items get equal numbers."""
    table: dict = {}
    return np.fromiter(map(table.setdefault, items, count()), np.int64, len(items))


def statistics(text: str | None) -> np.ndarray:
    """The numbers of ``STATISTICS`` for a whole text; null counts as empty, and an empty text has zeros only."""
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    bits = _kinds()[codes]
    n = len(codes)
    share = lambda bit: np.count_nonzero(bits & bit) / n
    letters = np.count_nonzero(bits & _LETTER)
    used = np.bincount(np.minimum(codes, 0x500))                    # rarer scripts count as one
    used = used[used > 0] / n
    out[0] = np.log1p(n)
    out[3], out[5], out[6], out[7], out[8] = letters / n, share(_DIGIT), share(_BLANK), share(_PUNCTUATION), share(_SYMBOL)
    out[4] = np.count_nonzero(bits & _UPPER) / max(1, letters)
    out[9] = np.count_nonzero(codes > 127) / n
    out[10] = -(used * np.log2(used)).sum()
    words = text.encode("utf-8", "surrogatepass").split()           # bytes: ASCII blanks only
    lines = [s for line in text.split("\n") if (s := line.strip())]
    out[2] = np.log1p(len(lines))
    if lines:
        out[20] = len(words) / len(lines)
        out[21] = 1 - len(set(lines)) / len(lines)
        out[22] = sum(line[-1] in ".!?:;\"'" for line in lines) / len(lines)
    if not words:
        return out
    ids = _numbered(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    often = np.bincount(ids)
    distinct = np.count_nonzero(often)
    m = len(words)
    out[1] = np.log1p(m)
    out[11], out[12], out[13] = sizes.mean(), sizes.std(), np.log1p(sizes.max())
    out[14], out[15], out[23] = distinct / m, often.max() / m, distinct / np.sqrt(m)
    if m > 1:
        out[16] = np.count_nonzero(ids[1:] == ids[:-1]) / (m - 1)
    if m > 2:
        triples = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_counts=True)[1] if m < 64 else \
            np.unique((ids[:-2] * m + ids[1:-1]) * np.int64(0x9E3779B1) + ids[2:], return_counts=True)[1]
        out[17] = triples[triples > 1].sum() / (m - 2)
    blank = np.flatnonzero((bits & _BLANK) > 0)
    edges = np.r_[0, np.cumsum((bits & _LETTER) > 0)]
    starts, ends = np.r_[0, blank + 1], np.r_[blank, n]
    real = ends > starts
    starts, ends = starts[real], ends[real]
    if len(starts):
        out[18] = np.count_nonzero(edges[ends] == edges[starts]) / len(starts)
        out[19] = np.count_nonzero(bits[ends - 1] & _SYMBOL) / len(starts)
    return out


@dataclass
class Forest:
    """All trees in flat arrays; ``roots`` says where each begins. A leaf leads to itself, and only leaves have a value."""
    bias: float
    roots: np.ndarray
    statistic: np.ndarray
    edge: np.ndarray           # statistics up to the edge go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        if not len(self.roots):
            return out
        for at in range(0, len(rows), _STEP):
            part = rows[at:at + _STEP]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            line = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[line, self.statistic[node]] <= self.edge[node], self.left[node], self.right[node])
            out[at:at + _STEP] += self.value[node].sum(1)
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def _bin_edges(rows: np.ndarray) -> list[np.ndarray]:
    """Inner edges of the bins of each statistic: quantiles of its distinct values' middles, at most ``BINS`` - 1."""
    out = []
    for column in rows.T:
        values = np.unique(column)
        middles = (values[1:] + values[:-1]) / 2
        if len(middles) >= BINS:
            cuts = np.unique(np.quantile(column, np.arange(1, BINS) / BINS, method="lower"))
            middles = np.unique(middles[np.minimum(np.searchsorted(values, cuts), len(middles) - 1)])
        out.append(middles)
    return out


def _grown(bins: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, curve: np.ndarray) -> tuple[list[list], np.ndarray]:
    """One tree, as rows (statistic, edge, left, right, value) with places relative to its root, and each row's leaf."""
    nodes = [[0, np.inf, 0, 0, 0.0]]
    where = np.zeros(len(bins), np.int64)
    level = [0]
    width = max((len(e) for e in edges), default=0) + 1
    for deep in range(DEPTH + 1):
        rank = np.full(len(nodes), -1)
        rank[level] = np.arange(len(level))
        place = rank[where]
        inside = np.flatnonzero(place >= 0)
        place = place[inside]
        g = np.bincount(place, slope[inside], len(level))
        h = np.bincount(place, curve[inside], len(level))
        for i, node in enumerate(level):
            nodes[node][4] = float(-RATE * g[i] / (h[i] + SHRINK))
        if deep == DEPTH:
            break
        best = np.zeros(len(level)) + 1e-6
        choice = np.full((len(level), 2), -1)
        for s, cuts in enumerate(edges):
            if not len(cuts):
                continue
            cell = place * width + bins[inside, s]
            low_g, low_h = (np.cumsum(np.bincount(cell, x[inside], len(level) * width).reshape(len(level), width), 1)[:, :len(cuts)]
                            for x in (slope, curve))
            high_g, high_h = g[:, None] - low_g, h[:, None] - low_h
            gain = low_g ** 2 / (low_h + SHRINK) + high_g ** 2 / (high_h + SHRINK) - (g ** 2 / (h + SHRINK))[:, None]
            gain = np.where((low_h >= LEAF_WEIGHT) & (high_h >= LEAF_WEIGHT), gain, 0)
            top = gain.argmax(1)
            better = gain[np.arange(len(level)), top] > best
            best = np.where(better, gain[np.arange(len(level)), top], best)
            choice[better] = np.stack([np.full(len(level), s), top], 1)[better]
        following = []
        for i, node in enumerate(level):
            s, cut = choice[i]
            if s < 0:
                continue
            to = len(nodes)
            nodes[node] = [int(s), float(edges[s][cut]), to, to + 1, 0.0]
            nodes += [[0, np.inf, to, to, 0.0], [0, np.inf, to + 1, to + 1, 0.0]]
            mine = inside[place == i]
            where[mine] = np.where(bins[mine, s] <= cut, to, to + 1)
            following += [to, to + 1]
        if not following:
            break
        level = following
    return nodes, where


def trained(rows: np.ndarray, labels: np.ndarray, seed: int = 12) -> Forest:
    """Boosted trees for the logarithmic loss. A fifth of the rows, if there are 50, is held back to end the rounds.

    Rows of one label only, or none, give a forest without trees: its score is the share of label 1, by the rule of
    succession.
    """
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held, used = np.split(order, [len(rows) // 5 if len(rows) >= 50 else 0])
    share = (labels[used].sum() + 1) / (len(used) + 2)
    bias = float(np.log(share / (1 - share)))
    edges = _bin_edges(rows[used]) if len(used) else []
    digitized = lambda part: np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, part.T)], 1)
    trees: list[list[list]] = []
    if 0 < labels[used].sum() < len(used):
        bins, y = digitized(rows[used]), labels[used]
        margin, held_margin = np.full(len(used), bias), np.full(len(held), bias)
        best, at_best = np.inf, 0
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            nodes, leaf = _grown(bins, edges, p - y, p * (1 - p))
            trees.append(nodes)
            margin += np.array([n[4] for n in nodes])[leaf]
            if len(held):
                held_margin += _flat(0.0, [nodes]).margin(rows[held])
                loss = np.logaddexp(0, np.where(labels[held] == 1, -held_margin, held_margin)).mean()
                if loss < best:
                    best, at_best = loss, len(trees)
                elif len(trees) - at_best >= PATIENCE:
                    break
        if len(held):
            trees = trees[:at_best]
    return _flat(bias, trees)


def _flat(bias: float, trees: list[list[list]]) -> Forest:
    starts = np.cumsum([0, *map(len, trees)])
    nodes = [[s, e, left + at, right + at, v] for tree, at in zip(trees, starts) for s, e, left, right, v in tree]
    s, e, left, right, v = ([n[i] for n in nodes] for i in range(5))
    whole = lambda x: np.array(x, np.int64)
    return Forest(bias, starts[:-1].astype(np.int64), whole(s), np.array(e, float), whole(left), whole(right), np.array(v, float), DEPTH)


def described(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``stats`` in place of its text."""
    return from_text(df, text, "stats array<double>", lambda: lambda texts: [[statistics(t) for t in texts]], 256)


def labelled_sample(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels (0 or 1) of about ``sample`` ids that have a label, at most twice as many.

    ``rows``: ``id``, ``stats``; ``labels``: ``id``, ``label``. An id counts once (its smallest statistics); of
    contradicting labels the one most given, 1 on a tie.
    """
    truth = labels.filter(F.col("id").isNotNull() & F.col("label").isNotNull()).groupBy("id").agg(
        (F.avg(F.col("label").cast("double")) >= 0.5).cast("int").alias("label"))
    once = checkpointed(rows.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("stats").alias("stats")).join(truth, "id"))
    n = once.count()
    bound = (1 << 63) - 1 if n <= sample else (sample << 64) // n - (1 << 63)        # whole numbers: never rounds to nothing
    drawn = once.filter(F.xxhash64(F.col("id").cast("string")) <= F.lit(bound)).orderBy(F.xxhash64(F.col("id").cast("string")), "id") \
        .limit(2 * sample).select("stats", "label").toPandas()
    stats = np.stack(drawn["stats"].to_list()).astype(float) if len(drawn) else np.zeros((0, len(STATISTICS)))
    return stats, drawn["label"].to_numpy(np.int64)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
           least: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """A row for each row of ``df``: the id, ``held_out``, ``score`` (0 to 1, probability of label 1), ``predicted`` (1 from
    ``least`` on). Trees learn from labelled ids that are not held out; a score looks at nothing but the text.

    Null ids are never held out and have no label; ids may be repeated. A null text counts as empty, and an empty one is
    scored like any other by its statistics (all zero). Without labels every score is 0.5. Other columns are not read.
    """
    whole = df.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text).alias("text"))
    rows = checkpointed(described(whole))
    known = labels.select(F.col(id_col).alias("id"), F.col(label).alias("label"))
    forest = trained(*labelled_sample(rows.filter(~F.col("held_out")), known, sample))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = b.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(STATISTICS))
            score = forest.probability(stats)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("held_out"), pa.array(score), pa.array((score >= least).astype(np.int32))],
                names=["id", "held_out", "score", "predicted"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
