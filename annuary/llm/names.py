"""Variant spellings of organisation names, linked by a pigeonhole segment join.

A typed name is taken apart into stem, kind words and town (orgnames). Two stems within K edits share, if one
is cut into K + 1 segments, at least one segment unharmed, at most K places from where it was. So segments of
every stem go into an inverted index, the shifted substrings of every stem look them up, and a banded edit
distance verifies the hits. Stems cut short are looked up in the same way, with one edit, among the beginnings
of the others, and initials with none. Every spelling then points to the heaviest near spelling; following the
pointers gives the organisation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.llm.canonical import plain_city
from annuary.llm.orgnames import NO_PLACE, PREFIX_WORDS, fold, parse
from annuary.session import cut_lineage, fan_out, salted_join

#: Edits between two spellings of one stem.
K = 2
#: Over how many parts the rows of an organisation or a spelling that very many rows share are spread.
SALT = 32

_WORD = re.compile(r"[^\W_]+")
_PARTS = "institution string, city string, spelling string, stem string, head string, kind string, of boolean, cut boolean, initials string, town string"


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _PARTS.split(", ")]
    for batch in batches:
        rows = []
        for text, city in zip(batch["institution"], batch["city"], strict=True):
            p = parse(text)
            if p is None or not (p.stem or p.initials):
                continue
            words = p.stem.split()
            head = words[0] if len(words) > 1 and words[0] in PREFIX_WORDS else ""
            town = plain_city(city) if isinstance(city, str) else ""
            town = "" if town in NO_PLACE else town
            rows.append((text, city, " ".join(_WORD.findall(fold(text))), " ".join(words[1:]) if head else p.stem, head, p.kind, p.of, p.cut, "".join(sorted(p.initials)), town if len(town) > 3 else p.town))
        yield pd.DataFrame(rows, columns=names)


def spellings(bridge: DataFrame) -> DataFrame:
    """Rows that name an organisation: bridge_id, shard, n_events and the parts of the name, with the spelling's number."""
    rows = bridge.select(F.col("bridge_id").cast("bigint").alias("bridge_id"), "shard", "institution", "city", F.coalesce("n_events", F.lit(0)).alias("n_events"))
    parsed = fan_out(rows.select("institution", "city").where("institution is not null").distinct()).mapInPandas(_parse_batches, _PARTS)
    named = rows.alias("r").join(parsed.alias("p"), (F.col("r.institution") == F.col("p.institution")) & F.col("r.city").eqNullSafe(F.col("p.city")))
    return named.select("bridge_id", "shard", "n_events", "spelling", "stem", "head", "kind", "of", "cut", "initials", "town").withColumn(
        "node", F.unhex(F.md5(F.to_json(F.struct("shard", "stem", "head", "kind", "of", "cut", "initials"))))
    )


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per spelling of a shard, with its weight and the town most often beside it.

    n_forms counts the forms that differ in more than letter case and punctuation, so copies of a row are one.
    """
    by = ["node", "shard", "stem", "head", "kind", "of", "cut", "initials"]
    towns = rows.where("town <> ''").groupBy("node", "town").agg(F.count("*").alias("n")).groupBy("node").agg(F.max_by("town", F.struct("n", "town")).alias("town"))
    forms = rows.groupBy(*by, "spelling").agg((F.count("*") + F.sum("n_events")).alias("weight"))
    weights = forms.groupBy(*by).agg(F.sum("weight").alias("weight"), F.count("*").alias("n_forms"))
    return weights.join(towns, "node", "left")


def limit_of(length: int) -> int:
    """Edits that a stem of this length may have: none up to 3 letters, one up to 5, else K."""
    return 0 if length <= 3 else min(1, K) if length <= 5 else K


def selections(edits: int) -> list[tuple[int, int, int]]:
    """(longer by, segment, shift): which substrings of a text can be an unharmed segment of another within edits.

    Of two texts within so many edits, one cut into edits + 1 segments, some segment i is unharmed while fewer
    than i edits lie before it or fewer than edits - i after it. Counted from the left it has then moved by at
    most i places, counted from the right, where the difference in length shows, by at most edits - i.
    """
    return [
        (d, i, s)
        for d in range(-edits, edits + 1)
        for i in range(edits + 1)
        for s in range(-edits, edits + 1)
        if abs(s) <= i and abs(s - d) <= edits - i
    ]


def _segment(length: Column, i: Column, parts: Column) -> tuple[Column, Column]:
    """Where segment i of so many begins in a text of the given length (from 0), and how long it is."""
    begin = F.floor(i * length / parts).cast("int")
    return begin, F.floor((i + 1) * length / parts).cast("int") - begin


def _edits(length: Column) -> Column:
    return F.when(length <= 3, 0).when(length <= 5, min(1, K)).otherwise(K)


def _pieces(text: str, choices: list[tuple[int, int, int, int]]) -> Column:
    """Array of struct<length, i, segment>: of the choices (edits, longer by, segment, shift) the substrings that exist.

    A choice is for texts that are shorter by so much and of a length that may have so many edits.
    """
    c = F.col(text)

    def piece(x: Column) -> Column:
        n = F.length(c) - x["d"]
        begin, size = _segment(n, x["i"], x["e"] + 1)
        at = begin + x["s"]
        exists = (n > 0) & (_edits(n) == x["e"]) & (at >= 0) & (size > 0) & (at + size <= F.length(c))
        return F.when(exists, F.named_struct(F.lit("length"), n, F.lit("i"), x["i"], F.lit("segment"), c.substr(at + 1, size)))

    fixed = F.array(*[F.named_struct(*[y for name, v in zip("edis", x, strict=True) for y in (F.lit(name), F.lit(v))]) for x in choices])
    return F.array_compact(F.transform(fixed, piece))


def segment_pairs(nodes: DataFrame) -> DataFrame:
    """(x, y, d), in both directions: full stems of one shard and head with the edits between them, as many as allowed.

    Kinds must be equal, or one of the two a bare stem. A pair may come several times.
    """
    full = nodes.where("not cut and initials = '' and stem <> ''")
    limits = sorted({limit_of(k) for k in range(12)})
    own = [(edits, 0, i, 0) for edits in limits for i in range(edits + 1)]
    wanted = [(edits, *choice) for edits in limits for choice in selections(edits)]
    # A bare stem may also have lost the direction before it.
    any_head = F.when(F.col("under") == "*", F.lit("*")).otherwise(F.col("head")).alias("head")
    kinds = lambda bare, other: F.explode(F.when(F.col("kind") == "", bare).otherwise(other)).alias("under")
    index = full.select(F.col("node").alias("y"), "shard", "head", F.col("stem").alias("y_stem"), kinds(F.array(F.lit("")), F.array(F.col("kind"), F.lit("*"))), _pieces("stem", own).alias("w"))
    probe = full.select(F.col("node").alias("x"), "shard", "head", F.col("stem").alias("x_stem"), kinds(F.array(F.lit(""), F.lit("*")), F.array(F.col("kind"))), _pieces("stem", wanted).alias("w"))
    index = index.select("y", "y_stem", "shard", any_head, "under", F.explode("w").alias("w")).select("y", "y_stem", "shard", "head", "under", "w.*")
    probe = probe.select("x", "x_stem", "shard", any_head, "under", F.explode("w").alias("w")).select("x", "x_stem", "shard", "head", "under", "w.*")
    near = probe.join(index, ["shard", "head", "under", "length", "i", "segment"]).where("x <> y").withColumn("d", F.levenshtein("x_stem", "y_stem", K))
    return near.where((F.col("d") >= 0) & (F.col("d") <= _edits(F.least(F.length("x_stem"), F.length("y_stem"))))).select("x", "y", "d")


def beginning_pairs(nodes: DataFrame) -> DataFrame:
    """(x, y, d): stems cut short, and full stems of the same shard, head and kind that begin like them.

    The beginning may have one edit if it has more than three letters. It is cut into two segments then, and
    looked up among the segments of all beginnings of full stems of its length, or of a whole stem one shorter.
    """
    h = lambda m: F.floor(m / 2).cast("int")

    def piece(size: Column, i: int, at: Column, long: Column) -> Column:
        return F.named_struct(F.lit("length"), size, F.lit("i"), F.lit(i), F.lit("segment"), F.col("stem").substr(at + 1, long))

    cut = nodes.where("cut and stem <> ''").withColumn("m", F.length("stem"))
    m = F.col("m")
    own = F.when(m <= 3, F.array(piece(m, 0, F.lit(0), m))).otherwise(F.array(piece(m, 0, F.lit(0), h(m)), piece(m, 1, h(m), m - h(m))))
    probe = cut.select(F.col("node").alias("x"), F.col("stem").alias("x_stem"), "shard", "head", "kind", F.explode(own).alias("w")).select("x", "x_stem", "shard", "head", "kind", "w.*")
    full = nodes.where("not cut and initials = '' and stem <> ''").withColumn("n", F.length("stem"))

    def of_length(size: Column) -> Column:
        # A whole stem one letter shorter than the cut one stands one place further left at its end.
        moved = F.when(size > F.col("n"), 1).otherwise(0)
        return F.when(size <= 3, F.array(piece(size, 0, F.lit(0), size))).otherwise(F.array(piece(size, 0, F.lit(0), h(size)), piece(size, 1, h(size) - moved, size - h(size))))

    sizes = F.filter(F.sequence(F.lit(1), F.col("n") + 1), lambda k: (k <= F.col("n")) | (k > 3))
    index = full.select(F.col("node").alias("y"), F.col("stem").alias("y_stem"), "shard", "head", "kind", F.explode(F.flatten(F.transform(sizes, of_length))).alias("w")).select("y", "y_stem", "shard", "head", "kind", "w.*")
    near = probe.join(index, ["shard", "head", "kind", "length", "i", "segment"])
    d = F.levenshtein(F.col("x_stem"), F.expr("substr(y_stem, 1, length(x_stem))"), 1)
    return near.withColumn("d", d).where("d >= 0").select("x", "y", "d")


def initial_pairs(nodes: DataFrame) -> DataFrame:
    """(x, y, d): names that are only initials, and full names of the shard with those initials.

    Initials allow no edit, so they are one segment.
    """
    words = F.filter(F.split(F.concat_ws(" ", "head", "stem", "kind"), " "), lambda w: w != "")
    full = nodes.where("not cut and initials = '' and stem <> '' and kind <> ''").select(
        F.col("node").alias("y"), "shard", F.array_join(F.array_sort(F.transform(words, lambda w: F.substring(w, 1, 1))), "").alias("initials")
    )
    return nodes.where("initials <> ''").select(F.col("node").alias("x"), "shard", "initials").join(full, ["shard", "initials"]).select("x", "y", F.lit(0).alias("d"))


def parents(nodes: DataFrame) -> DataFrame:
    """(x, y): the spelling that each spelling stands for, where there is a better one."""
    pairs = segment_pairs(nodes).unionByName(beginning_pairs(nodes)).unionByName(initial_pairs(nodes))
    side = lambda p: nodes.select(*[F.col(c).alias(f"{p}_{c}") for c in ("node", "stem", "head", "kind", "of", "cut", "initials", "weight", "n_forms", "town")])
    both = pairs.join(side("x"), F.col("x") == F.col("x_node")).join(side("y"), F.col("y") == F.col("y_node"))
    d = F.col("d")
    apart = F.coalesce(F.levenshtein("x_town", "y_town") > 2, F.lit(False))
    together = F.col("x_town").isNotNull() & F.col("y_town").isNotNull() & ~apart
    heavier = F.struct("y_weight", "y") > F.struct(F.col("x_weight").alias("y_weight"), F.col("x").alias("y"))
    bare = (F.col("x_kind") == "") & (F.col("y_kind") != "")
    # 'University of X' and 'X University' may be two; only a lone spelling is taken to have lost or won an 'of'.
    same_of = F.col("x_of") == F.col("y_of")
    same_kind, same_head = F.col("x_kind") == F.col("y_kind"), F.col("x_head") == F.col("y_head")
    # Two separate edits are as often another name; a swap of neighbours is one slip.
    letters = lambda c: F.array_sort(F.split(c, ""))
    sure = (d < K) | together | (letters("x_stem") == letters("y_stem"))
    full = (F.col("x_initials") == "") & ~F.col("x_cut")
    allowed = (
        ((F.col("x_initials") != "") & ~apart)
        | F.col("x_cut")
        | (full & sure & ((bare & (same_head | (F.col("x_head") == ""))) | (same_head & same_kind & heavier & ~(apart & (F.col("x_n_forms") > 1)) & (same_of | (~apart & (F.col("x_n_forms") == 1))))))
    )
    rank = F.struct((~bare & (F.col("x_kind") == "")).alias("r0"), (~bare & ~same_of).alias("r0b"), apart.alias("r1"), (~together).alias("r2"), d.alias("r3"), (F.col("x_stem") != F.col("y_stem")).alias("r3b"), (~same_head).alias("r3c"), (-F.col("y_weight")).alias("r4"), F.col("y").alias("r5"))
    return both.where(allowed).groupBy("x").agg(F.min_by("y", rank).alias("y"))


def organisations(nodes: DataFrame) -> DataFrame:
    """(node, root): the organisation of every spelling, by following the pointers to their end."""
    up = cut_lineage(nodes.select(F.col("node").alias("x")).join(parents(nodes), "x", "left").select("x", F.coalesce("y", "x").alias("y")))
    while True:
        nxt = up.alias("a").join(up.alias("b"), F.col("a.y") == F.col("b.x")).select(F.col("a.x").alias("x"), F.col("b.y").alias("y"), (F.col("b.y") != F.col("a.y")).alias("moved"))
        nxt = cut_lineage(nxt)
        up = nxt.select("x", "y")
        if not nxt.where("moved").take(1):
            return up.select(F.col("x").alias("node"), F.col("y").alias("root"))


def organisation_of(bridge: DataFrame) -> DataFrame:
    """(bridge_id, shard, root) of every row that names an organisation; rows of one root name the same.

    Null and blank strings, and those that name no organisation, have no row. Repeated rows each have one.
    """
    rows = cut_lineage(spellings(bridge))
    nodes = cut_lineage(fan_out(nodes_of(rows)))  # a node gives dozens of segments
    roots = organisations(nodes)
    return salted_join(rows.select("bridge_id", "shard", "node"), roots, ["node"], F.col("bridge_id"), SALT).select("bridge_id", "shard", "root")


def organisation_classes(bridge: DataFrame) -> DataFrame:
    """(bridge_id, organisation, n_links) of every row that names an organisation.

    organisation is the smallest bridge_id of its class, n_links the number of the other rows of the class.
    """
    rows = cut_lineage(organisation_of(bridge))
    classes = rows.groupBy("shard", "root").agg(F.min("bridge_id").alias("organisation"), (F.count("*") - 1).alias("n_links"))
    return salted_join(rows, classes, ["root"], F.col("bridge_id"), SALT).select("bridge_id", "organisation", "n_links")


def linked_rows(bridge: DataFrame) -> DataFrame:
    """(bridge_id_a, bridge_id_b), smaller first: all rows of one shard that name the same organisation."""
    rows = cut_lineage(organisation_of(bridge).select("bridge_id", "root"))
    other = rows.withColumnRenamed("bridge_id", "b")
    pairs = salted_join(rows.withColumnRenamed("bridge_id", "a"), other, ["root"], F.col("a"), SALT)
    return pairs.where("a < b").select(F.col("a").alias("bridge_id_a"), F.col("b").alias("bridge_id_b"))
