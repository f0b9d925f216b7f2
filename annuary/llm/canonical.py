"""Mapping of free-entered values to a reference list by BK-trees.

Values and entries are brought to the same plain form first (case, accents, punctuation, known abbreviations,
word order); what is left are misprints, and the BK-tree returns every entry within the threshold. The trees of
the reference list are built once and broadcast, in shards of bounded size that are searched one after another;
the best answer of the shards wins. Only distinct values are looked up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuary.llm.bktree import BKTree
from annuary.llm.orgnames import EMPTY_WORDS, PREFIX_WORDS, fold, parse
from annuary.session import fan_out

#: Letters of the entries of one shard of the reference list. A shard is broadcast, with its trees some twenty
#: times as large, so this bounds the broadcast.
SHARD_LETTERS = 1_000_000
#: Lookups that a task keeps at hand; bounds memory only.
REMEMBERED = 50_000
LIMIT = 2

#: Other names of countries, plain form -> plain form of the usual entry.
COUNTRY_NAMES = {
    "usa": ["us", "u s", "u s a", "usa", "united states", "united states of america", "america"],
    "canada": ["can", "dominion of canada", "canada"],
    "england": ["eng", "england", "great britain", "gt brit"],
    "scotland": ["scot", "scotland"],
    "germany": ["ger", "germany", "deutschland"],
    "france": ["fr", "france", "la france"],
    "austria": ["aust", "austria", "oesterreich", "osterreich"],
    "switzerland": ["switz", "switzerland", "schweiz", "suisse"],
    "netherlands": ["neth", "netherlands", "the netherlands", "holland", "nederland"],
    "sweden": ["swed", "sweden", "sverige"],
    "italy": ["it", "ital", "italy", "italia"],
    "japan": ["jap", "japan", "nippon"],
    "china": ["china", "chine"],
    "india": ["ind", "india", "ind brit", "india brit", "british india"],
    "denmark": ["den", "denmark", "danmark"],
    "belgium": ["belg", "belgium", "belgique", "belgie"],
}
#: Short forms of words in names of subjects.
SUBJECT_WORDS = {
    "zoology": ["zool", "zoo"], "botany": ["bot"], "chemistry": ["chem"], "physics": ["phys"], "mathematics": ["math", "maths"],
    "astronomy": ["astron", "astr"], "geology": ["geol"], "paleontology": ["paleont", "paleontol", "palaeontology"],
    "mineralogy": ["mineral", "minlogy", "min"], "physiology": ["physiol"], "pathology": ["path", "pathol"], "anatomy": ["anat"],
    "bacteriology": ["bact", "bacteriol"], "entomology": ["ent", "entom", "entomol"], "psychology": ["psychol", "psych"],
    "anthropology": ["anthrop", "anthropol"], "electrical": ["elec", "elect"], "engineering": ["eng", "engin", "engrg"],
    "civil": ["civ"], "mechanical": ["mech", "mechan"], "horticulture": ["hort"], "agronomy": ["agron"], "forestry": ["for", "forest"],
    "meteorology": ["meteor", "meteorol"], "genetics": ["genet", "gen"], "geography": ["geog", "geogr"], "pharmacology": ["pharmacol", "pharm"],
    "metallurgy": ["metall", "metal"], "organic": ["org", "organ"], "analytical": ["anal", "analyt"], "agricultural": ["agr", "agric"],
    "physiological": ["physiolog"], "plant": ["plants"],
}
#: Words that mean something else beside the word 'chemistry'.
BESIDE_CHEMISTRY = {"physics": "physical", "physiology": "physiological"}

_SUBJECT = {short: word for word, shorts in SUBJECT_WORDS.items() for short in shorts}
_COUNTRY = {short: word for word, shorts in COUNTRY_NAMES.items() for short in shorts}
_PREFIX = {short: word for word, shorts in PREFIX_WORDS.items() for short in [*shorts, *(["st"] if word == "saint" else [])]}


def plain(text: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", fold(text)))


def plain_city(text: str) -> str:
    """Town without what follows a comma, '(near)' and a trailing 'City', prefixes spelt out."""
    head = re.split(r"[,;(|]", fold(text).strip(" ,;|"))[0]
    words = re.findall(r"[^\W_]+", head)
    if len(words) > 1 and words[-1] == "city":
        words = words[:-1]
    if len(words) > 1 and words[0] in _PREFIX:
        words[0] = _PREFIX[words[0]]
    return " ".join(words)


def plain_subject(text: str) -> str:
    """Words of a subject in alphabetical order, abbreviations spelt out."""
    words = [_SUBJECT.get(w, w) for w in re.findall(r"[^\W_]+", fold(text)) if w not in ("of", "and", "the")]
    if "chemistry" in words and len(words) > 1:
        words = [BESIDE_CHEMISTRY.get(w, w) for w in words]
    return " ".join(sorted(words))


def plain_country(text: str) -> str:
    p = plain(text)
    return _COUNTRY.get(p, p)


def country_keys(text: str) -> list[str]:
    """The plain form of a country and all its other names."""
    return sorted({plain(text), *COUNTRY_NAMES.get(plain_country(text), [])})


def near_enough(a: str, b: str, d: int) -> bool:
    """Whether d edits are few for strings of this length: none up to 3 letters, one up to 6, and a swap of neighbours."""
    n = min(len(a), len(b))
    if d <= (0 if n <= 3 else 1 if n <= 6 else LIMIT):
        return True
    return d == 2 and n > 3 and swapped(a, b)


def swapped(a: str, b: str) -> bool:
    """Whether two neighbouring letters changed places."""
    if len(a) != len(b):
        return False
    off = [i for i in range(len(a)) if a[i] != b[i]]
    return len(off) == 2 and off[1] == off[0] + 1 and a[off[0]] == b[off[1]] and a[off[1]] == b[off[0]]


class PlainIndex:
    """Entries of one list by their plain form, or by several forms each."""

    def __init__(self, entries: list[tuple], form, keys=None) -> None:
        self.form = form
        self.tree = BKTree((key, e) for e in entries for key in (keys(e[1]) if keys else [form(e[1])]))

    def candidates(self, value: str) -> list[tuple]:
        """(distance, entry, False) of every entry that is near enough."""
        key = self.form(value)
        out = []
        for d, found, entries in self.tree.within(key, LIMIT) if key else ():
            if near_enough(key, found, d):
                # A short other name is too easily reached from a different word.
                out += [(d, e, False) for e in entries if not d or len(found) >= 8 or found == self.form(e[1])]
        return out


def disagreement(context: tuple, state: str | None, country: str | None) -> int:
    """How many of state and country contradict the row's own."""
    n = 0
    if context[1] and state and plain(context[1])[:4] != plain(state)[:4]:
        n += 1
    if context[2] and country and plain_country(context[2]) != plain_country(country):
        n += 1
    return n


class OrganisationIndex:
    """Entries that are organisations: a tree over their stems; cut stems have trees over beginnings."""

    def __init__(self, entries: list[tuple]) -> None:
        parsed = [(e, parse(e[1])) for e in entries]
        self.entries = [(e, p) for e, p in parsed if p is not None]
        self.stems = BKTree((key, (e, p)) for e, p in self.entries for key in {p.stem, without_head(p.stem)})
        self.beginnings: dict[int, BKTree] = {}
        self.initials = BKTree((initials_of(e[1]), e) for e, _ in self.entries)
        self.near: dict[tuple[str, bool], list[tuple]] = {}  # what was found for a stem

    def _cut_tree(self, n: int) -> BKTree:
        if n not in self.beginnings:
            self.beginnings[n] = BKTree((p.stem[:n], (e, p)) for e, p in self.entries if len(p.stem) > n)
        return self.beginnings[n]

    def _near(self, stem: str, cut: bool) -> list[tuple]:
        """(distance, key, entry, its parts, whether it only begins like the stem) of the entries near a stem."""
        found = self.near.get((stem, cut))
        if found is None:
            found = [(d, k, e, q, False) for d, k, v in self.stems.within(stem, LIMIT) if near_enough(stem, k, d) for e, q in v]
            if cut:
                found += [(d, k, e, q, True) for d, k, v in self._cut_tree(len(stem)).within(stem, 1) for e, q in v]
            if len(self.near) >= REMEMBERED:
                self.near.clear()
            self.near[stem, cut] = found
        return found

    def candidates(self, value: str) -> list[tuple]:
        """(distance, entry, whether the place must agree) of every entry that is near enough and of the same kind.

        The distance counts an 'of' more or less in the name of a university as a quarter.
        """
        p = parse(value)
        if p is None or not (p.stem or p.initials):
            return []
        if p.initials:
            # Initials allow no edit. Where several entries have them, only one whose place agrees will do.
            found = [e for _, _, v in self.initials.within(p.initials, 0) for e in v]
            return [(0, e, len(found) > 1) for e in found]
        # A bare stem two edits away, or the beginning of one with an edit, could well be another name.
        found = [(d, e, q, d > 0 if begins else d == LIMIT and not p.kind and not swapped(p.stem, k)) for d, k, e, q, begins in self._near(p.stem, p.cut)]
        # Only a bare stem may have lost its kind words, or the direction before it.
        return [
            (d + (0.25 if p.kind and p.of != q.of else 0), e, place)
            for d, e, q, place in found
            if (not p.kind or p.kind == q.kind) and (head_of(p.stem) == head_of(q.stem) or not (p.kind or head_of(p.stem)))
        ]


def head_of(stem: str) -> str:
    first = stem.split()[0] if " " in stem else ""
    return first if first in PREFIX_WORDS else ""


def without_head(stem: str) -> str:
    return stem.split(" ", 1)[1] if head_of(stem) else stem


def initials_of(name: str) -> str:
    return "".join(w[0] for w in re.findall(r"[^\W_]+", fold(name)) if w not in EMPTY_WORDS)


def choose(candidates: list[tuple], context: tuple) -> tuple[int, int, int] | None:
    """(distance, disagreement with the context, ref_id) of the best candidate.

    A candidate whose place must agree counts only if the row's state, or else its country, is known.
    """
    ranks = [(d, disagreement(context, e[2], e[3]), e[0], place) for d, e, place in candidates]
    known = bool(context[1] or context[2])
    return min((r[:3] for r in ranks if not r[3] or (known and not r[1])), default=None)


def build_index(list_name: str, entries: list[tuple]):
    if list_name == "institution":
        return OrganisationIndex(entries)
    if list_name == "country":
        return PlainIndex(entries, plain, country_keys)
    return PlainIndex(entries, {"city": plain_city, "department": plain_subject}.get(list_name, plain))


def shards(canonical: DataFrame, list_name: str, letters: int = SHARD_LETTERS) -> Iterator[list[tuple]]:
    """Entries (ref_id, entry, state, country) of a list in blocks of at most so many letters, by length.

    An entry is read once, one block is held at a time.
    """
    block: list[tuple] = []
    held = 0
    listed = canonical.where((F.col("list_name") == list_name) & F.col("entry").isNotNull())
    for r in listed.select("ref_id", "entry", "state_region", "country").orderBy(F.length("entry"), "ref_id").toLocalIterator():
        size = sum(len(x) for x in r if isinstance(x, str))
        if block and held + size > letters:
            yield block
            block, held = [], 0
        block.append(tuple(r))
        held += size
    if block:
        yield block


_HIT = "value string, c1 string, c2 string, distance double, off int, ref_id bigint"


def map_values(values: DataFrame, canonical: DataFrame, list_name: str) -> DataFrame:
    """(value, c1, c2, ref_id) for every distinct (value, c1, c2); ref_id 0 where the list has no entry near enough.

    c1 and c2 are the state and the country beside the value, null if unknown; they only decide between
    entries that are equally near. Ties that remain go to the smallest ref_id. Null and blank values must have
    been taken out; an empty list gives 0 for every value.
    """
    # The lookup is heavy per value, and a value beside several places should be looked up by one task.
    distinct = fan_out(values.select("value", "c1", "c2").distinct(), "value")
    spark = values.sparkSession
    hits = None
    for block in shards(canonical, list_name):
        shared = spark.sparkContext.broadcast(build_index(list_name, block))

        def look(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            names = [x.split()[0] for x in _HIT.split(", ")]
            near = lru_cache(maxsize=REMEMBERED)(shared.value.candidates)
            for batch in batches:
                rows = []
                for value, c1, c2 in zip(batch["value"], batch["c1"], batch["c2"], strict=True):
                    found = choose(near(value), (None, c1, c2))
                    if found:
                        rows.append((value, c1, c2, *found))
                yield pd.DataFrame(rows, columns=names)

        part = distinct.mapInPandas(look, _HIT)
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return distinct.withColumn("ref_id", F.lit(0).cast("bigint"))
    best = hits.groupBy("value", "c1", "c2").agg(F.min_by("ref_id", F.struct("distance", "off", "ref_id")).alias("ref_id"))
    same = (F.col("d.value") == F.col("b.value")) & F.col("d.c1").eqNullSafe(F.col("b.c1")) & F.col("d.c2").eqNullSafe(F.col("b.c2"))
    return distinct.alias("d").join(best.alias("b"), same, "left").select("d.value", "d.c1", "d.c2", F.coalesce("b.ref_id", F.lit(0).cast("bigint")).alias("ref_id"))


def map_field(rows: DataFrame, canonical: DataFrame, field: str, record_id: str, list_name: str, state: str | None = None, country: str | None = None) -> DataFrame:
    """(field, record_id, ref_id) of every row whose value is neither blank nor letter by letter an entry of the list."""
    none = F.lit(None).cast("string")
    values = rows.select(
        F.col(record_id).cast("bigint").alias("record_id"),
        F.col(field).alias("value"),
        (F.col(state) if state else none).alias("c1"),
        (F.col(country) if country else none).alias("c2"),
    ).where(F.col("value").rlike(r"(?U)\S"))
    exact = canonical.where(F.col("list_name") == list_name).select(F.col("entry").alias("value"))
    open_ = values.join(exact, "value", "left_anti")
    mapped = map_values(open_, canonical, list_name)
    same = (F.col("v.value") == F.col("m.value")) & F.col("v.c1").eqNullSafe(F.col("m.c1")) & F.col("v.c2").eqNullSafe(F.col("m.c2"))
    return open_.alias("v").join(mapped.alias("m"), same).select(F.lit(field).alias("field"), "v.record_id", "m.ref_id")


def mapped_values(spark: SparkSession, bridge: DataFrame, profiles: DataFrame, canonical: DataFrame) -> DataFrame:
    parts = [
        map_field(bridge, canonical, "institution", "bridge_id", "institution", "state_region", "country"),
        map_field(bridge, canonical, "city", "bridge_id", "city", "state_region", "country"),
        map_field(bridge, canonical, "country", "bridge_id", "country"),
        map_field(profiles, canonical, "department", "profile_id", "department"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
