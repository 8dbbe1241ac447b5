"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

A solution is a set of bins, not a list of places: crossover takes whole, well filled bins of one parent into the other,
removes the bins that hold the same documents, and places what those bins held besides by best fit. Fitness is the mean
squared filling (few full bins beat many half full ones).

Pieces are dealt into groups of bounded size by a hash of their place in the file. Several islands evolve a population
of their own for each group, as tasks of their own; after an epoch the best solution of each island migrates to the next
one by a shuffle, and evolution goes on; at the end each group takes its best solution. A group is never larger than a
few thousand pieces, so memory and time of a task do not depend on the corpus. What groups leave part empty is pooled over
all of them and evolved again, until one group is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import checkpointed
from .shared import as_scan, numbered, whole_text
from .vocabulary import END_OF_WORD, LOWER_WORDS, SOLID, WESTERN_BLANKS, byte_letters, load, merges_only

GROUP = 2048              # pieces of a group, on average
ISLANDS = 3
POPULATION = 4
OFFSPRING = 8             # crossovers per island and epoch
EPOCHS = 2
REOPENED = 16             # one in so many sequences of a group, the emptiest, is opened again and pooled
LAST_OFFSPRING = 48       # crossovers where pooled pieces are one group: nothing can be pooled any more
CACHE = 1_000_000         # words whose ids a worker keeps
_BATCH = 4096             # unknown words that are encoded in one call


class WordEncoder:
    """Ids of a tokenizer that lower-cases and drops blanks, as little-endian 32-bit numbers, word by word.

    Such a tokenizer never looks across a word, so a text's ids are those of its words one after the other. Western
    European text is split here by the tokenizer's own rule; words not seen before go through its merges only, many in
    one call, and each ends at the id that carries the end-of-word mark. Any other text goes to the library in chunks
    between blanks.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.merges = merges_only(path)
        self.special = [s.content for s in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(END_OF_WORD)]] = True
        self.known: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        """Ids of words not known yet."""
        if len(self.known) + len(words) > CACHE:
            self.known.clear()
        fresh = list(words)
        for i in range(0, len(fresh), _BATCH):
            part = fresh[i:i + _BATCH]
            spelled = " ".join([w if w.isascii() else byte_letters(w) for w in part])
            ids = np.array(self.merges.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
            raw, begin = ids.tobytes(), 0
            for w, end in zip(part, (4 * np.flatnonzero(self.ends[ids]) + 4).tolist(), strict=True):
                self.known[w] = raw[begin:end]
                begin = end

    def chunk(self, chunk: str) -> bytes:
        ids = self.chunks.get(chunk)
        if ids is None:
            ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
            if len(self.chunks) >= CACHE // 4:
                self.chunks.clear()
            if len(chunk) <= 64:
                self.chunks[chunk] = ids
        return ids

    def words(self, text: str) -> list[str] | None:
        """The words of a Western European text, None for any other."""
        if not WESTERN_BLANKS.fullmatch(text) or any(s in text for s in self.special):
            return None
        return LOWER_WORDS.findall(text.lower())

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), 256):
            part = texts[i:i + 256]
            words = [self.words(t) for t in part]
            ids = [list(map(self.known.get, w)) if w is not None else None for w in words]
            gaps = [[j for j, x in enumerate(x) if x is None] if x is not None and None in x else () for x in ids]
            self.learn({w[j] for w, g in zip(words, gaps) for j in g})
            for t, w, x, g in zip(part, words, ids, gaps):
                for j in g:
                    x[j] = self.known[w[j]]
                yield b"".join(x) if x is not None else b"".join(map(self.chunk, SOLID.findall(t)))


def pieces(df: DataFrame, path: str, limit: int = 2048, end_id: int = 0, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Documents as token ids with an end mark, cut only where longer than ``limit``: the id, ``piece``, ``start``,
    ``length`` and ``ids`` (binary, little-endian unsigned 32-bit).

    A null text is empty: one piece of the end mark. Ids may be null or repeated; columns other than id and text are not
    read. Texts of any length are read whole.
    """
    plain = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    mark, width = int(end_id).to_bytes(4, "little"), 4 * limit

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                source, number, cuts = [], [], []
                for i, ids in enumerate(encoder.encode(part.column(1).to_pylist())):
                    ids += mark
                    for j, begin in enumerate(range(0, len(ids), width)):
                        source.append(i)
                        number.append(j)
                        cuts.append(ids[begin:begin + width])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(source, pa.int64())), pa.array(number, pa.int32()),
                     pa.array([j * limit for j in number], pa.int64()), pa.array([len(c) // 4 for c in cuts], pa.int64()),
                     pa.array(cuts, pa.binary())], names=["id", "piece", "start", "length", "ids"])

    kind = dict(plain.dtypes)["id"]
    return plain.mapInArrow(work, f"id {kind}, piece int, start bigint, length bigint, ids binary") \
        .withColumnRenamed("id", id_col)


# ---- one group -------------------------------------------------------------------------------------------------

class Bins:
    """Bins under construction, found by the room they have left: the fullest one that still fits first."""

    def __init__(self, limit: int):
        self.limit = limit
        self.members: list[list[int]] = []
        self.room: list[int] = []
        self.at: list[list[int]] = [[] for _ in range(limit + 1)]   # bins by room
        self.open = 0                                                # bit r: some bin has room r

    def add(self, items: list[int], room: int) -> None:
        self.members.append(items)
        self.room.append(room)
        self._file(len(self.room) - 1, room)

    def _file(self, b: int, room: int) -> None:
        self.at[room].append(b)
        self.open |= 1 << room

    def best_fit(self, item: int, size: int) -> None:
        fits = self.open >> size
        if not fits:
            self.add([item], self.limit - size)
            return
        room = size + (fits & -fits).bit_length() - 1
        b = self.at[room].pop()
        if not self.at[room]:
            self.open ^= 1 << room
        self.members[b].append(item)
        self.room[b] = room - size
        self._file(b, room - size)

    def assignment(self, n: int) -> np.ndarray:
        out = np.empty(n, np.int32)
        for b, items in enumerate(self.members):
            out[items] = b
        return out


def _filled(sizes: np.ndarray, where: np.ndarray) -> np.ndarray:
    return np.bincount(where, sizes).astype(np.int64)


def fitness(sizes: np.ndarray, where: np.ndarray, limit: int) -> float:
    return float(np.mean((_filled(sizes, where) / limit) ** 2)) if len(sizes) else 1.0


def packed_in_order(sizes: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    bins = Bins(limit)
    for i in order.tolist():
        bins.best_fit(i, int(sizes[i]))
    return bins.assignment(len(sizes))


def crossover(sizes: np.ndarray, into: np.ndarray, donor: np.ndarray, limit: int, rng: np.random.Generator) -> np.ndarray:
    """Some of the donor's best filled bins go into the other parent whole; what they displace is placed by best fit."""
    filled = _filled(sizes, donor)
    count = max(1, int(len(filled) * rng.uniform(0.2, 0.6)))
    given = np.argsort(-filled + rng.uniform(0, limit / 50, len(filled)), kind="stable")[:count]
    taken = np.isin(donor, given)
    broken = np.zeros(into.max() + 1, bool)
    broken[into[taken]] = True                                   # bins with a duplicate are removed
    bins = Bins(limit)
    for where, rows in ((donor, np.flatnonzero(taken)), (into, np.flatnonzero(~taken & ~broken[into]))):
        rows = rows[np.argsort(where[rows], kind="stable")]
        for part in np.split(rows, np.flatnonzero(np.diff(where[rows])) + 1) if len(rows) else []:
            bins.add(part.tolist(), limit - int(sizes[part].sum()))
    displaced = np.flatnonzero(~taken & broken[into])
    for i in displaced[np.argsort(-sizes[displaced], kind="stable")].tolist():
        bins.best_fit(i, int(sizes[i]))
    return bins.assignment(len(sizes))


def evolved(sizes: np.ndarray, population: list[np.ndarray], limit: int, seed: tuple[int, ...],
            offspring: int = OFFSPRING, size: int = POPULATION) -> list[np.ndarray]:
    """The population after some crossovers, best first. A seed of its own makes a repeated task give the same."""
    rng = np.random.default_rng(seed)
    least = -(-int(sizes.sum()) // limit)
    people = list(population)
    while len(people) < size:
        order = np.argsort(-sizes * rng.uniform(1 - 0.1 * bool(people), 1, len(sizes)), kind="stable")
        people.append(packed_in_order(sizes, order, limit))
    rank = lambda w: (int(w.max()) + 1 if len(w) else 0, -fitness(sizes, w, limit))
    people.sort(key=rank)
    for _ in range(offspring):
        if rank(people[0])[0] <= least:
            break                                                # no packing has fewer bins
        a, b = rng.choice(len(people), 2, replace=False)
        people.append(crossover(sizes, people[a], people[b], limit, rng))
        people = sorted(people, key=rank)[:size]
    return sorted(people, key=rank)[:size]


# ---- the whole table -------------------------------------------------------------------------------------------

_STATE = "grp bigint, island int, seat int, bins bigint, fit double, sizes binary, placed binary"


def _state_rows(grp: int, island: int, sizes: np.ndarray, people: list[np.ndarray], limit: int) -> pd.DataFrame:
    raw = sizes.astype("<i4").tobytes()
    return pd.DataFrame([(grp, island, seat, int(w.max()) + 1, fitness(sizes, w, limit), raw, w.astype("<i4").tobytes())
                         for seat, w in enumerate(people)],
                        columns=["grp", "island", "seat", "bins", "fit", "sizes", "placed"])


def _packed_groups(rows: DataFrame, groups: int, limit: int, islands: int, epochs: int, offspring: int, seed: int) -> DataFrame:
    """``row``, ``size`` -> also ``grp``, ``bin`` and ``offset``: pieces dealt into groups, each packed by islands that send
    their best to the next one."""
    dealt = checkpointed(rows.select("row", "size", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(groups)).cast("long").alias("grp")))

    def first(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = np.sort(rows["size"].to_numpy(np.int64))[::-1].copy()
        people = evolved(sizes, [], limit, (seed, keys[0], keys[1], 0), offspring)
        return _state_rows(keys[0], keys[1], sizes, people, limit)

    def later(epoch: int):
        def work(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["bins", "fit", "seat"], ascending=[True, False, True], kind="stable")
            sizes = np.frombuffer(rows["sizes"].iloc[0], "<i4").astype(np.int64)
            people = [np.frombuffer(p, "<i4") for p in rows["placed"]]
            return _state_rows(keys[0], keys[1], sizes, evolved(sizes, people, limit, (seed, *keys, epoch), offspring), limit)
        return work

    apart = dealt.select("grp", "size", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    state = checkpointed(apart.groupBy("grp", "island").applyInPandas(first, _STATE))
    for epoch in range(1, epochs):
        migrants = state.filter("seat = 0").withColumn("island", (F.col("island") + 1) % islands).withColumn("seat", F.lit(-1))
        state = checkpointed(state.unionByName(migrants).groupBy("grp", "island").applyInPandas(later(epoch), _STATE))
    best = state.groupBy("grp").agg(F.min_by("placed", F.struct("bins", -F.col("fit"), "island", "seat")).alias("placed"))

    def place(keys: tuple, rows: pd.DataFrame, winner: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["row", "size", "grp", "bin", "offset"])
        rows = rows.sort_values(["size", "row"], ascending=[False, True], kind="stable").reset_index(drop=True)
        where = np.frombuffer(winner["placed"].iloc[0], "<i4").astype(np.int64)
        sizes = rows["size"].to_numpy(np.int64)
        order = np.argsort(where, kind="stable")
        ends = np.cumsum(sizes[order])
        begin = ends - sizes[order]
        first_of = np.r_[True, where[order][1:] != where[order][:-1]]
        offset = np.empty(len(rows), np.int64)
        offset[order] = begin - np.maximum.accumulate(np.where(first_of, begin, 0))
        return pd.DataFrame({"row": rows["row"], "size": sizes, "grp": keys[0], "bin": where, "offset": offset})

    return dealt.groupBy("grp").cogroup(best.groupBy("grp")).applyInPandas(
        place, "row bigint, size int, grp bigint, bin bigint, offset bigint")


def _emptiest(placed: DataFrame) -> DataFrame:
    """The bins of each group with most room: one in ``REOPENED``, four at least. A group's bins are bounded by its size."""
    bins = placed.groupBy("grp", "bin").agg(F.sum("size").alias("filled"))
    group = Window.partitionBy("grp")
    ranked = bins.withColumns({"rank": F.row_number().over(group.orderBy("filled", "bin")), "n": F.count("*").over(group)})
    return ranked.filter(F.col("rank") <= F.greatest(F.lit(4), F.col("n") / REOPENED)).select("grp", "bin")


def pack(parts: DataFrame, limit: int = 2048, group: int = GROUP, islands: int = ISLANDS, epochs: int = EPOCHS,
         seed: int = 7) -> DataFrame:
    """Any table with ``length`` (1 to ``limit``) -> all its columns, ``sequence_id`` and ``offset``.

    Pieces as long as a sequence are one each. Within a sequence
    pieces lie without gaps, longest first. Rows that are equal are still rows of their own; an empty table gives an
    empty one. Other columns pass through, but a ``sequence_id`` or ``offset`` already there is replaced.

    Each group leaves some sequences part empty. So the emptiest ones of all groups are opened again, and their pieces are
    dealt into new groups, a sixteenth as many, and packed anew; this goes on as long as it saves sequences, down to one
    group, and at last once among the emptiest sequences of all. A level that saves none is not taken.
    """
    whole = numbered(as_scan(parts).drop("sequence_id", "offset").select(
        F.struct("*").alias("whole"), F.col("length").cast("int").alias("size")), "row")
    left = whole.filter(F.col("size") < limit).select("row", "size")
    groups = max(1, -(-left.count() // group))
    placed = checkpointed(_packed_groups(left, groups, limit, islands, epochs, OFFSPRING, seed))
    settled, level = [], 0
    while groups > 1:
        opened = checkpointed(_emptiest(placed))
        again = checkpointed(placed.join(opened, ["grp", "bin"], "left_semi").select("row", "size"))
        fewer = max(1, -(-again.count() // group))
        if fewer >= groups:
            break
        offspring = LAST_OFFSPRING if fewer == 1 else OFFSPRING
        anew = checkpointed(_packed_groups(again, fewer, limit, islands, epochs, offspring, seed + level + 1))
        if anew.select("grp", "bin").distinct().count() >= opened.count():
            break
        settled.append(placed.join(opened, ["grp", "bin"], "left_anti").withColumn("level", F.lit(level)))
        placed, groups, level = anew, fewer, level + 1
    settled.append(placed.withColumn("level", F.lit(level)))
    found = reduce(DataFrame.unionByName, settled)
    bins = found.groupBy("level", "grp", "bin").agg(F.sum("size").alias("filled"), F.count("*").alias("n"))
    used, total = bins.agg(F.count("*"), F.coalesce(F.sum("filled"), F.lit(0))).first()
    if used > -(-total // limit):
        # once more the emptiest sequences of all, as many as one task takes
        order = ["filled", "level", "grp", "bin"]
        upto = F.sum("n").over(Window.orderBy(*order))                      # over the few sequences taken
        opened = checkpointed(bins.orderBy(*order).limit(max(4, group)).withColumn("upto", upto)
                              .filter(F.col("upto") <= 4 * group + limit).select("level", "grp", "bin"))
        again = checkpointed(found.join(opened, ["level", "grp", "bin"], "left_semi").select("row", "size"))
        anew = checkpointed(_packed_groups(again, 1, limit, islands, epochs, LAST_OFFSPRING, seed + level + 1))
        if anew.select("bin").distinct().count() < opened.count():
            found = found.join(opened, ["level", "grp", "bin"], "left_anti").unionByName(anew.withColumn("level", F.lit(level + 1)))
    # an even number: ten bits of level, 32 of group, twenty of bin
    number = F.lit(2) * ((F.col("level").cast("long") * (1 << 32) + F.col("grp")) * (1 << 20) + F.col("bin"))
    packed = whole.join(found.select("row", number.alias("sequence_id"), "offset"), "row").select("whole.*", "sequence_id", "offset")
    full = whole.filter(F.col("size") >= limit).select(
        "whole.*", (F.lit(2) * F.col("row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def packed_documents(df: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text: str = "text",
                     keep_ids: bool = False) -> DataFrame:
    """Documents -> one row per piece with its place; ``ids_crc32``, and with ``keep_ids`` the ids themselves."""
    cut = pieces(df, path, limit, 0, id_col, text).withColumn("ids_crc32", F.crc32("ids"))
    return pack(checkpointed(cut if keep_ids else cut.drop("ids")), limit)
