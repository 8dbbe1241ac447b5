"""Secrets in texts, and how widely each is owned.

A scan finds candidates by three fixed patterns. Over the whole corpus the hash of each candidate's value is aggregated
by distinct repositories and distinct owners: a value that many owners have is a widely copied example; one that a
single owner has and that looks random is a live-looking credential; one that a few owners have may have been copied with
a document and is hidden like a live one. The verdict comes back to every document as spans of the values themselves.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .shared import as_scan, from_text, join_on_hot_key, numbered

# The base patterns, and the smallest lengths that count.
ASSIGN = re.compile(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
                    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")        # maximal runs; shorter ones would be dropped
LEAST = {"assign": 6, "access": 20}
KINDS = ("assign", "access", "hex", "live", "shared", "few")   # order at equal starts; the last three are added by ownership
HIDDEN = ("live", "few")                  # verdicts whose values are masked

FOUND = "array<struct<kind:string,start:int,end:int,value_start:int,hash:string,random:boolean>>"


def looks_random(value: str) -> bool:
    """At least 12 characters with digits or mixed case, no character making up a quarter, and 2.5 bits a character."""
    if len(value) < 12:
        return False
    counts = Counter(value)
    bits = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    mixed = any(c.isdigit() for c in value) or value.lower() != value != value.upper()
    return bits >= 2.5 and mixed and max(counts.values()) * 4 <= len(value)


def scan(text: str | None) -> list[tuple]:
    """Base candidates of a whole text, leftmost and non-overlapping per kind, by start, then kind. Offsets are code
    points, ends exclusive; ``value_start`` is where the value itself begins."""
    if not text:
        return []
    out = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST["assign"]:
            out.append((m.start(), 0, m.end(), m.start(2)))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= LEAST["access"]:
            out.append((m.start(), 1, m.end(), m.start()))
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    found = []
    for start, kind, end, value_start in sorted(out):
        value = text[value_start:end]
        found.append((KINDS[kind], start, end, value_start, hashlib.sha256(value.encode()).hexdigest(), looks_random(value)))
    return found


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``found`` (base candidates with the hash of their values, never the values) in place of its text."""
    names = ("kind", "start", "end", "value_start", "hash", "random")
    return from_text(df, text, f"found {FOUND}",
                     lambda: lambda texts: [[[dict(zip(names, x)) for x in scan(t)] for t in texts]])


def ownership(found: DataFrame) -> DataFrame:
    """``repo``, ``owner``, ``found`` -> per ``hash``: ``repos`` and ``owners``, distinct non-null ones.

    First one row per value, repository and owner, then per value and owner, then per value: a value that stands in a
    third of all documents is reduced before each shuffle, and its owners are never listed.
    """
    each = found.select("repo", "owner", F.explode("found.hash").alias("hash")).distinct()
    by_owner = each.groupBy("hash", "owner").agg(F.count_distinct("repo").alias("n"))
    owners = by_owner.groupBy("hash").agg(F.count("owner").alias("owners"))
    repos = each.select("hash", "repo").distinct().groupBy("hash").agg(F.count("repo").alias("repos"))
    return owners.join(repos, "hash")


def classified(df: DataFrame, repo: Column, owner: Column, id_col: str = "doc_id", text: str = "text",
               example_owners: int = 3) -> DataFrame:
    """One row per input row: ``row``, the id, and ``found`` with ``repos``, ``owners`` and a ``verdict`` per candidate.

    ``shared``: at least ``example_owners`` owners have the value. ``live``: at most one owner has it and it looks
    random. ``few``: it looks random and has more owners than one, but too few for an example. ``unclear``: the rest.
    Null or empty text: nothing found. Null owners and repositories count as none. Ids may be null or repeated. Only the
    columns named are read.
    """
    slim = numbered(as_scan(df).select(F.col(id_col).alias("id"), repo.cast("string").alias("repo"),
                                       owner.cast("string").alias("owner"), F.col(text).alias("text")), "row")
    found = checkpointed(candidates(slim))
    known = checkpointed(ownership(found))
    each = checkpointed(found.select("row", F.posexplode("found").alias("pos", "f")).select("row", "pos", "f", F.col("f.hash").alias("hash")))
    verdict = (
        F.when(F.col("owners") >= example_owners, "shared")
        .when((F.col("owners") <= 1) & F.col("f.random"), "live").when(F.col("f.random"), "few").otherwise("unclear"))
    judged = join_on_hot_key(each, known, "hash").select(
        "row", F.struct("pos", F.col("f.kind").alias("kind"), F.col("f.start").alias("start"), F.col("f.end").alias("end"),
                        F.col("f.value_start").alias("value_start"), "hash", "repos", "owners", verdict.alias("verdict")).alias("c"))
    grouped = judged.groupBy("row").agg(F.sort_array(F.collect_list("c")).alias("judged"))
    none = F.array().cast(grouped.schema["judged"].dataType)
    return found.select("row", F.col("id").alias(id_col)).join(grouped, "row", "left").select(
        "row", id_col, F.coalesce("judged", none).alias("found"))


def spans_of(found: Column) -> Column:
    """All spans ``kind:start:end``: base candidates, and a span ``live``, ``shared`` or ``few`` over each value so judged."""
    def placed(f: Column, kind: Column, start: Column) -> Column:
        order = F.array_position(F.lit(list(KINDS)), kind)
        return F.struct(start.alias("start"), order.alias("order"), f["end"].alias("end"), kind.alias("kind"))

    base = F.transform(found, lambda f: placed(f, f["kind"], f["start"]))
    added = F.transform(F.filter(found, lambda f: f["verdict"] != "unclear"),
                        lambda f: placed(f, f["verdict"], f["value_start"]))
    return F.sort_array(F.array_distinct(F.concat(base, added)))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(df: DataFrame, repo: Column, owner: Column, id_col: str = "doc_id", text: str = "text",
             mark: str = "[secret]", example_owners: int = 3) -> DataFrame:
    """``df`` with every value judged ``live`` or ``few`` replaced by ``mark``; all rows, all columns, other texts as they are.

    Examples that many owners share stay. Only rows with something to hide meet the spans by a join.
    """
    df = as_scan(df)
    found = classified(df, repo, owner, id_col, text, example_owners)
    hide = checkpointed(found.select("row", F.transform(
        F.filter("found", lambda f: f["verdict"].isin(*HIDDEN)),
        lambda f: F.struct(f["value_start"].alias("start"), f["end"].alias("end"))).alias("spans")).filter(F.size("spans") > 0))
    kind = df.schema[text].dataType.simpleString()
    whole = numbered(df.select(F.struct("*").alias("whole")), "row")
    # merge overlapping spans, then take what lies between them
    merged = F.aggregate(
        F.sort_array("spans"), F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    body = F.col(f"whole.{text}").cast("string")
    between = F.concat(
        F.transform("merged", lambda s, i: F.substring(
            body, F.coalesce(F.get("merged", i - 1)["end"], F.lit(0)) + 1,
            s["start"] - F.coalesce(F.get("merged", i - 1)["end"], F.lit(0)))),
        F.array(F.substring(body, F.element_at("merged", -1)["end"] + 1, F.length(body))))
    hidden = (
        whole.join(hide, "row").withColumn("merged", merged)
        .select(F.col("whole").withField(text, F.array_join(between, mark).cast(kind)).alias("whole"))
    )
    return whole.join(hide.select("row"), "row", "left_anti").select("whole").unionByName(hidden).select("whole.*")
