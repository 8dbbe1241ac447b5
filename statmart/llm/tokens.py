"""Token counts of every prefix of a text by dynamic programming over a byte-level BPE vocabulary.

A sequence of tokens is the encoding of its bytes exactly if every two neighbours, encoded together, stay the same two
tokens. So the encoding of a prefix ends in the one token T for which the encoding of the prefix without T ends in a
token that stays apart from T, and ``count[i] = count[i - len(T)] + 1``: one table gives the exact count at every prefix.

Pre-tokenization never looks across the border of a chunk (see :mod:`vocabulary`), so counts add up over chunks, and over
the pre-tokens of a chunk. The table of a pre-token is kept for the next time it occurs. The whole text's count is the
count at its last prefix; the longest prefix within a budget needs the running sum and the tables of one chunk's
pre-tokens, which are there already: nothing is encoded again. A run of blanks is one pre-token as far as a prefix has
come, so one table serves all of its prefixes, however long it is.
"""

from __future__ import annotations

import functools
import json
from array import array

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .shared import from_text, whole_text
from .vocabulary import BLANK, CHUNKS, PIECES, WESTERN, byte_alphabet, load

CACHE = 1_000_000          # tables kept by a worker; beyond that it starts anew
_LONG = 256               # chunks longer than this are not kept
_SHORT = 24               # so far into a pre-token every beginning is tried, further on only the sizes of tokens with that end


class PrefixCounter:
    """Exact token counts at prefixes of strings, for one byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {c: b for b, c in byte_alphabet().items()}
        raw = lambda s: bytes(letters[c] for c in s)
        self.vocabulary = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: t for t, i in self.vocabulary.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        ends: dict[int, set[int]] = {}
        for token in self.vocabulary:
            ends.setdefault(token[-1], set()).add(len(token))
        self.sizes = {last: tuple(sorted(sizes, reverse=True)) for last, sizes in ends.items()}    # by last byte, longest first
        self.tokenizer = load(path)
        self.apart: dict[int, bool] = {}
        self.totals: dict[str, int] = _Totals(self)
        self.tables: dict[str, array] = {}
        self.blanks: dict[str, bool] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """Plain BPE of a few bytes: the pair of lowest rank first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(p, 1 << 40), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 40:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether token ``b`` (after ``a``, or alone if ``a`` is negative) is kept by the encoding of both."""
        key = (a + 1) << 20 | b
        known = self.apart.get(key)
        if known is None:
            first = [self.bytes_of[a]] if a >= 0 else []
            second = self.bytes_of[b]
            known = self.merged(b"".join(first) + second) == [*first, second]
            if len(self.apart) >= CACHE:
                self.apart.clear()
            self.apart[key] = known
        return known

    def word(self, data: bytes) -> array:
        """Token count at every byte prefix of one pre-token (index 0 is the empty prefix)."""
        count, last = array("I", [0]), [-1]
        vocabulary, known, stay_apart, sizes = self.vocabulary, self.apart, self.stay_apart, self.sizes
        for end in range(1, len(data) + 1):
            for begin in range(end) if end <= _SHORT else [end - n for n in sizes.get(data[end - 1], ()) if n <= end]:
                token = vocabulary.get(data[begin:end])
                if token is None:
                    continue
                before = last[begin]
                fits = known.get((before + 1) << 20 | token)
                if fits or fits is None and stay_apart(before, token):
                    last.append(token)
                    count.append(count[begin] + 1)
                    break
            else:
                raise ValueError("the vocabulary cannot spell these bytes")
        return count

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens: by the library, or for Western European text by the same rule without its overhead."""
        if WESTERN.fullmatch(text):
            return PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def prefixes(self, piece: str) -> array:
        """:meth:`word` of a pre-token, kept unless it is long."""
        table = self.tables.get(piece)
        if table is None:
            table = self.word(piece.encode())
            if len(piece) <= _LONG:
                if len(self.tables) >= CACHE // 2:
                    self.tables.clear()
                self.tables[piece] = table
        return table

    def is_blank(self, c: str) -> bool:
        """Whether the tokenizer takes a character for white space: two of them before a word are not one pre-token."""
        known = self.blanks.get(c)
        if known is None:
            known = self.blanks[c] = BLANK.match(c) is not None and not any(c + c in p for p in self.pieces(f"a{c}{c}a"))
        return known

    def _plain_total(self, text: str) -> int:
        prefixes = self.prefixes
        return sum([prefixes(p)[-1] for p in self.pieces(text)])

    def chunk_total(self, chunk: str) -> int:
        """Tokens of a chunk; a special string in it is one token, as the library has it by default."""
        total, rest = 0, chunk
        while rest:
            at, found = min(((i, s) for s in self.special if (i := rest.find(s)) >= 0), default=(len(rest), ""))
            total += (self._plain_total(rest[:at]) if at else 0) + bool(found)
            rest = rest[at + len(found):]
        return total

    def total(self, text: str) -> int:
        """Tokens of a whole text."""
        return sum(map(self.totals.__getitem__, CHUNKS.findall(text)))

    def chunk_table(self, chunk: str) -> array:
        """Count at every code point prefix of a chunk."""
        table, done, settled = array("q", [0]), 0, 0     # settled: tokens of the pre-tokens before the current one
        blanks = 0                                        # where the current run of blanks begins
        run, place_of = None, 0                           # the table of that run and how many of its bytes are done
        while done < len(chunk):
            at, found = min(((i, s) for s in self.special if (i := chunk.find(s, done)) >= 0), default=(len(chunk), ""))
            begin = last = blanks = done
            run = None
            upheld = settled                              # tokens before position last
            for p in self.pieces(chunk[done:at]) if at > done else []:
                counts, place, last, upheld = self.prefixes(p), 0, begin, settled
                for q, c in enumerate(p, 1):
                    place += len(c.encode())
                    upto = begin + q
                    if self.is_blank(c):        # blanks at the end of a prefix are one pre-token, however they go on
                        if run is None:
                            stop = upto
                            while stop < at and self.is_blank(chunk[stop]):
                                stop += 1
                            run, place_of = self.prefixes(chunk[blanks:stop]), 0
                        place_of += len(c.encode())
                        table.append(table[blanks] + run[place_of])
                        continue
                    blanks, run = upto, None
                    if p[0] == "'" and q < len(p):           # a contraction is none before its last letter
                        table.append(settled + self._plain_total(p[:q]))
                    else:
                        table.append(settled + counts[place])
                begin, settled = begin + len(p), settled + counts[-1]
            if found:
                if blanks < at:
                    last, upheld = blanks, table[blanks]
                for upto in range(at + 1, at + len(found)):      # not the special string yet, but its letters
                    table.append(upheld + self._plain_total(chunk[last:upto]))
                settled += 1
                table.append(settled)
            done = at + len(found)
        return table

    def table(self, text: str) -> np.ndarray:
        """Count at every code point prefix of a text, index 0 being the empty one."""
        out, base = [np.zeros(1, np.int64)], 0
        for chunk in CHUNKS.findall(text):
            counts = np.frombuffer(self.chunk_table(chunk), np.int64)
            out.append(base + counts[1:])
            base += int(counts[-1])
        return np.concatenate(out)

    def longest_prefix(self, text: str, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens."""
        base, place, best = 0, 0, 0
        for chunk in CHUNKS.findall(text):
            n = self.totals[chunk]
            if base + n > budget - len(chunk):       # near the budget: the chunk's own table decides
                counts = np.frombuffer(self.chunk_table(chunk), np.int64)
                best = place + int(np.flatnonzero(base + counts <= budget)[-1])
            else:
                best = place + len(chunk)
            base, place = base + n, place + len(chunk)
            if base > budget:
                break
        return best


class _Totals(dict):
    """Totals of chunks seen, filled as they come."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, chunk: str) -> int:
        n = self.counter.chunk_total(chunk)
        if len(chunk) <= _LONG:
            if len(self) >= CACHE:
                self.clear()
            self[chunk] = n
        return n


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(df: DataFrame, path: str, budget: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``budget`` tokens) and
    ``fits_chars``: code points of the longest prefix within the budget.

    A null text counts as empty: no bytes, no tokens, not over any limit. Ids may be null or repeated; every row is
    answered. Texts of any length are read whole. Columns other than id and text are not read. ``path`` must be
    readable on every executor.
    """
    def make():
        count = counter(path)

        def answer(texts: list) -> list[list]:
            totals = [count.total(t) for t in texts]
            fits = [len(t) if n <= budget else count.longest_prefix(t, budget) for t, n in zip(texts, totals)]
            return [[len(t.encode()) for t in texts], totals, fits]
        return answer

    plain = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    return from_text(plain, "text", "n_bytes bigint, n_tokens bigint, fits_chars bigint", make).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > budget).alias("over_limit"), "fits_chars")


def prefix_tables(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id and ``counts``, the token count at every code point prefix (one number more than code points).

    Null text: one zero. For tables that are to answer many budgets; memory is bounded by the longest texts.
    """
    def make():
        count = counter(path)
        return lambda texts: [[count.table(t) for t in texts]]

    plain = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    return from_text(plain, "text", "counts array<bigint>", make, 32).select(F.col("id").alias(id_col), "counts")


def prefix_within(counts: str, budget: int):
    """Column: code points of the longest prefix within a budget, from a prefix table alone."""
    # the last index whose count is within the budget; counts are not monotone inside a word, so look from the end
    return F.array_max(F.transform(F.col(counts), lambda c, i: F.when(c <= budget, i)))
