"""Postal addresses that denote the same location, by a set-containment join on rare tokens.

An address is taken apart into house number, direction, street, street kind, town and region. The tokens of
an address are its house number joined with the beginnings and ends of its street and town, so a misprint
spares some of them; a short street is a token as a whole. Each address is indexed under its rarest tokens
that any other address shares; every address probes with all its tokens, the fuller one thus finding the less
full. A candidate pair is verified by weighted containment: of the weight of what the less full address says,
CONTAINED at least must be in the other, up to misprints, and no component may contradict.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annuary.llm.canonical import plain_city
from annuary.llm.classes import components
from annuary.llm.orgnames import KIND_WORDS, PREFIX_WORDS, edit_distance, fold
from annuary.session import cut_lineage, fan_out, salted_join

#: Kinds of streets and their short forms.
STREET_KINDS = {
    "street": ["street", "st", "str"],
    "avenue": ["avenue", "av", "ave", "avnue"],
    "road": ["road", "rd"],
    "place": ["place", "pl"],
    "terrace": ["terrace", "ter", "terr"],
    "court": ["court", "ct", "crt"],
    "boulevard": ["boulevard", "blvd", "bvd", "boul"],
    "lane": ["lane", "ln"],
    "drive": ["drive", "dr"],
    "square": ["square", "sq"],
}
#: Compass words before a street name.
DIRECTIONS = {"north": ["north", "n", "no"], "south": ["south", "s", "so"], "east": ["east", "e"], "west": ["west", "w"]}
#: Regions after a town, in the forms people write; word sequences without punctuation.
REGIONS = {
    "mass": ["mass", "massachusetts"], "calif": ["calif", "cal", "california"], "ohio": ["ohio", "o"], "ill": ["ill", "ills", "illinois"],
    "pa": ["pa", "penn", "penna", "pennsylvania"], "kans": ["kans", "kan", "kansas"], "md": ["md", "maryland"], "que": ["que", "quebec"],
    "iowa": ["iowa", "ia"], "conn": ["conn", "ct", "connecticut"], "wash": ["wash", "washington"], "mich": ["mich", "michigan"],
    "wis": ["wis", "wisc", "wisconsin"], "minn": ["minn", "minnesota"], "texas": ["texas", "tex"], "va": ["va", "virginia"],
    "n y": ["n y", "ny", "new york"], "n j": ["n j", "nj", "new jersey"], "s dak": ["s dak", "s d", "sd", "so dak", "south dakota"],
    "n dak": ["n dak", "n d", "north dakota"], "nebr": ["nebr", "neb", "nebraska"], "ont": ["ont", "ontario"], "mo": ["mo", "missouri"],
    "ind": ["indiana"], "colo": ["colo", "colorado"], "ore": ["ore", "oregon"], "maine": ["maine", "me"], "vt": ["vt", "vermont"],
    "n h": ["n h", "nh", "new hampshire"], "r i": ["r i", "ri", "rhode island"], "d c": ["d c", "dc"], "ga": ["ga", "georgia"],
    "tenn": ["tenn", "tennessee"], "ky": ["ky", "kentucky"], "la": ["louisiana"], "ala": ["ala", "alabama"], "fla": ["fla", "florida"],
    "n c": ["n c", "north carolina"], "s c": ["s c", "south carolina"], "ariz": ["ariz", "arizona"], "utah": ["utah"], "mont": ["mont", "montana"],
    "man": ["man", "manitoba"], "b c": ["b c", "british columbia"], "usa": ["usa", "u s a", "u s", "united states"], "canada": ["canada", "can"],
    "england": ["england", "eng"], "scotland": ["scotland", "scot"], "germany": ["germany", "ger", "deutschland"], "france": ["france", "fr"],
    "austria": ["austria", "aust", "austia", "oesterreich"], "switzerland": ["switzerland", "switz", "schweiz", "suisse"],
    "netherlands": ["netherlands", "neth", "holland"], "sweden": ["sweden", "swed", "sverige"], "italy": ["italy", "ital", "italia"],
    "japan": ["japan", "jap"], "china": ["china", "chine"], "india": ["india", "ind", "ind brit", "india brit", "british india"], "denmark": ["denmark", "den", "danmark"],
    "belgium": ["belgium", "belg", "belgique"],
}
#: Words that begin a line naming a department.
DEPARTMENT_WORDS = {"dept", "department", "dep", "dep't", "dept."}

#: Tokens under which an address is indexed: a damaged word spoils two of them, so one is left. More would put
#: the tokens that every town has (a number and a common street) into the index.
INDEX_TOKENS = 3
#: What the components weigh in the containment, about the bits that each tells; and the share that must be contained.
WEIGHTS = {"number": 8.0, "street": 9.0, "town": 8.0, "region": 4.0, "kind": 2.0, "direction": 2.0}
CONTAINED = 0.6
#: Over how many parts the addresses of a token, or the rows of a text, that very many share are spread.
SALT = 32
#: Letters of a street up to which it gives whole-word tokens; these are all indexed, beside the rarest others.
SHORT = 4
_KIND = {short: word for word, shorts in STREET_KINDS.items() for short in shorts}
_DIRECTION = {short: word for word, shorts in DIRECTIONS.items() for short in shorts}
_REGION = {short: word for word, shorts in REGIONS.items() for short in shorts}
_PLACE_PREFIX = {"saint", "st", "mount", "mt", "fort", "ft", "north", "n", "no", "south", "s", "so", "east", "e", "west", "w"}
_ORGANISATION = {w for word, shorts in KIND_WORDS.items() if word not in ("state", "company") for w in shorts} - {"st", "u", "col", "nat"} | {"univ", "coll", "col"}
_SPELT = {short: word for word, shorts in PREFIX_WORDS.items() for short in shorts} | {"st": "saint"}


@dataclass(frozen=True)
class Address:
    number: str
    direction: str
    street: str
    kind: str
    town: str
    region: str


def strip_regions(words: list[str]) -> tuple[list[str], str]:
    """Words without a region at the end, and that region."""
    for n in (4, 3, 2, 1):
        if len(words) >= n and " ".join(words[-n:]) in _REGION:
            rest, more = strip_regions(words[:-n])
            return rest, more or _REGION[" ".join(words[-n:])]
    return words, ""


@lru_cache(maxsize=100_000)
def _street_kind(word: str) -> str | None:
    if word in _KIND:
        return _KIND[word]
    if len(word) >= 5:
        for kind in STREET_KINDS:
            if len(kind) >= 5 and abs(len(kind) - len(word)) <= 1 and edit_distance(word, kind) <= (1 if len(kind) < 8 else 2):
                return kind
    return None


def _holds_street(words: list[str]) -> bool:
    return any(_street_kind(w) and len(v) > 3 and v not in _ORGANISATION and n not in _ORGANISATION for v, w, n in zip(words, words[1:], [*words[2:], ""], strict=False))


def _town(words: list[str]) -> str:
    words = [w for w in words if w not in ("near", "city")]
    if len(words) > 1 and words[0] in _SPELT:
        words = [_SPELT[words[0]], *words[1:]]
    return " ".join(words)


def parse(text: str | None, city: str | None) -> Address | None:
    """The components of an address; None if it is null or blank. Unknown components are empty."""
    if text is None or not text.strip():
        return None
    segments = [s for s in ([w for w in re.findall(r"[^\W_]+", part)] for part in re.split(r"[,;|]", fold(text))) if s]
    # Lines that name a department or an organisation say nothing about the place, unless a street is in them.
    kept = [s for s in segments if any(w.isdigit() for w in s) or _holds_street(s) or (s[0] not in DEPARTMENT_WORDS and not any(w in _ORGANISATION for w in s))]
    number_at = [(i, j) for i, s in enumerate(kept) for j, w in enumerate(s) if w.isdigit()]
    if not number_at:
        kept, number_at = segments, [(i, j) for i, s in enumerate(segments) for j, w in enumerate(s) if w.isdigit()]
    if not kept:
        kept = segments
    number = kept[number_at[0][0]][number_at[0][1]] if number_at else ""
    ni, nj = number_at[0] if number_at else (-1, -1)

    def is_name(s: list[str], j: int) -> bool:
        return 0 <= j < len(s) and len(s[j]) >= 3 and not s[j].isdigit() and s[j] not in _DIRECTION and s[j] not in _REGION and _street_kind(s[j]) is None and s[j] not in _PLACE_PREFIX

    street = kind = direction = ""
    where: tuple[int, int, int] | None = None  # segment, first word, word after the last
    order = sorted(range(len(kept)), key=lambda i: (i != ni, abs(i - ni)))
    for i in order:
        s = kept[i]
        for j in range(1, len(s)):
            k = _street_kind(s[j])
            if k and is_name(s, j - 1) and not (s[j] in ("st", "ct", "dr") and i != ni and abs(i - ni) > 1):
                street, kind, where = s[j - 1], k, (i, j - 1, j + 1)
                break
        if where:
            break
    if not where and number:
        s = kept[ni]
        j = nj + 1
        while j < len(s) and s[j] in _DIRECTION:
            j += 1
        if is_name(s, j):
            street, where = s[j], (ni, j, j + 1)
        else:
            back = nj - 1
            if back >= 0 and s[back] == "no":
                back -= 1
            if is_name(s, back):
                street, where = s[back], (ni, back, back + 1)
            else:
                near = [ni - 1, ni + 1] if nj > 0 and s[nj - 1] == "no" else [ni + 1, ni - 1]
                for i in near:
                    if 0 <= i < len(kept):
                        names = [j for j in range(len(kept[i])) if is_name(kept[i], j)]
                        if names and len(kept) > 2 - (city is not None):
                            street, where = kept[i][names[0]], (i, names[0], names[0] + 1)
                            break
    if where:
        i, a, b = where
        s = kept[i]
        if a > 0 and s[a - 1] in _DIRECTION and not (s[a - 1] == "no" and (a < 2 or not s[a - 2].isdigit()) and a + 0 < len(s) and any(w.isdigit() for w in s[: a - 1])):
            # 'no' right before a number is 'number'; before a name it is 'north'.
            direction = _DIRECTION[s[a - 1]]
            a -= 1
        where = (i, a, b)
    left: list[list[str]] = []
    for i, s in enumerate(kept):
        rest = list(s)
        if where and i == where[0]:
            before, after = s[: where[1]], s[where[2] :]
            for part in (before, after):
                part = [w for k, w in enumerate(part) if not w.isdigit() and not (w == "no" and (k + 1 == len(part) or part[k + 1].isdigit()))]
                if part:
                    left.append(part)
            continue
        rest = [w for k, w in enumerate(rest) if not w.isdigit() and not (w == "no" and (k + 1 == len(rest) or rest[k + 1].isdigit()))]
        if rest:
            left.append(rest)
    region = ""
    towns = []
    for part in left:
        words, r = strip_regions(part)
        region = region or r
        if any(len(w) >= 4 for w in words):
            towns.append(_town(words))
    town = plain_city(city) if city and city.strip() else ""
    if not town and towns:
        town = towns[-1]
    return Address(number, direction, street, kind, town, region)


def name_tokens(a: Address) -> list[str]:
    """House number joined with the beginnings and ends of the street and of the words of the town.

    A short street gives itself and itself without each of its letters: two of them one edit apart share one.
    """
    out = set()
    for w in [a.street, *a.town.split()]:
        if len(w) >= 4 and w not in ("saint", "mount", "fort", "north", "south", "falls", "springs", "junction"):
            out |= {f"{a.number}^{w[:4]}", f"{a.number}{w[-4:]}$"}
    if a.number and 0 < len(a.street) <= SHORT:
        out |= {f"{a.number}={a.street[:i]}{a.street[i + 1 :]}" for i in range(len(a.street))} | {f"{a.number}={a.street}"}
    return sorted(out)


def alike(a: str, b: str) -> bool:
    """Equal up to misprints: one edit in short words, else up to three, a swap of neighbours counting as two."""
    if a == b:
        return True
    n = max(len(a), len(b))
    limit = 1 if n < 5 else 2 if n < 8 else 3
    return abs(len(a) - len(b)) <= limit and edit_distance(a, b) <= limit


def contained(a: Address, b: Address) -> float:
    """The share of the weight of what the less full address says that the other says too, up to misprints."""
    both = [f for f in WEIGHTS if getattr(a, f) and getattr(b, f) and alike(getattr(a, f), getattr(b, f))]
    said = [sum(w for f, w in WEIGHTS.items() if getattr(x, f)) for x in (a, b)]
    return sum(WEIGHTS[f] for f in both) / min(said) if min(said) else 0.0


def same_place(a: Address, b: Address) -> bool:
    """Whether one address contains what the other says and nothing contradicts.

    House numbers must be equal and streets alike. Direction, kind of street and town contradict when both
    are known and differ; where a town is unknown the regions must not differ, and kind and direction must be
    known to be equal.
    """
    if not a.number or a.number != b.number or not a.street or not b.street or not alike(a.street, b.street):
        return False
    if a.kind and b.kind and a.kind != b.kind:
        return False
    if a.direction != b.direction and a.direction and b.direction:
        return False
    if contained(a, b) < CONTAINED:
        return False
    if a.town and b.town:
        return alike(a.town, b.town)
    return a.kind == b.kind and a.direction == b.direction and (not a.region or not b.region or a.region == b.region)


def _alike(a: str, b: str) -> Column:
    """alike, on two columns."""
    n = F.greatest(F.length(a), F.length(b))
    limit = F.when(n < 5, 1).when(n < 8, 2).otherwise(3)
    return (F.col(a) == F.col(b)) | ((F.abs(F.length(a) - F.length(b)) <= limit) & (F.levenshtein(a, b) <= limit))


def is_same_place() -> Column:
    """same_place, on the columns a_<component> and b_<component>."""
    said = lambda s, f: F.col(f"{s}_{f}") != ""
    both = lambda f: said("a", f) & said("b", f)
    equal = lambda f: F.col(f"a_{f}") == F.col(f"b_{f}")
    weight = lambda f, when: F.when(when, WEIGHTS[f]).otherwise(0.0)
    total = lambda s: sum((weight(f, said(s, f)) for f in WEIGHTS), F.lit(0.0))
    common = sum((weight(f, both(f) & _alike(f"a_{f}", f"b_{f}")) for f in WEIGHTS), F.lit(0.0))
    place = F.when(both("town"), _alike("a_town", "b_town")).otherwise(equal("kind") & equal("direction") & (~both("region") | equal("region")))
    return (
        said("a", "number") & equal("number") & both("street") & _alike("a_street", "b_street")
        & (~both("kind") | equal("kind")) & (~both("direction") | equal("direction"))
        & place & (common >= F.least(total("a"), total("b")) * CONTAINED)
    )


_PARTS = "mailing_address string, mailing_city string, number string, direction string, street string, kind string, town string, region string, tokens array<string>"


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _PARTS.split(", ")]
    for batch in batches:
        rows = []
        for text, city in zip(batch["mailing_address"], batch["mailing_city"], strict=True):
            a = parse(text, city)
            if a is not None:
                rows.append((text, city, a.number, a.direction, a.street, a.kind, a.town, a.region, name_tokens(a)))
        yield pd.DataFrame(rows, columns=names)


_FIELDS = ("number", "direction", "street", "kind", "town", "region")


def located(rows: DataFrame) -> DataFrame:
    """Distinct (mailing_address, mailing_city) with components, tokens and a place number for equal components."""
    texts = rows.where(F.col("mailing_address").rlike(r"(?U)\S")).select("mailing_address", "mailing_city").distinct()
    return fan_out(texts).mapInPandas(_parse_batches, _PARTS).withColumn("place", F.unhex(F.md5(F.to_json(F.struct(*_FIELDS)))))


def place_links(places: DataFrame) -> DataFrame:
    """(a, b) with a < b: numbers of distinct component sets that denote one location."""
    one = cut_lineage(places.where("number <> '' and street <> ''").select("place", *_FIELDS, "tokens").dropDuplicates(["place"]))
    tokens = one.select("place", F.explode("tokens").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    whole = F.col("token").contains("=")
    ranked = cut_lineage(tokens.join(common, "token").withColumn("r", F.row_number().over(Window.partitionBy("place", whole).orderBy("n", "token"))))
    index = ranked.where(whole | (F.col("r") <= INDEX_TOKENS)).select("token", F.col("place").alias("i"))
    probe = ranked.select("token", F.col("place").alias("p"))
    pairs = salted_join(probe, index, ["token"], F.col("p"), SALT).where("p <> i").select(F.least("p", "i").alias("a"), F.greatest("p", "i").alias("b")).distinct()
    left = one.select(F.col("place").alias("a"), *[F.col(f).alias(f"a_{f}") for f in _FIELDS])
    right = one.select(F.col("place").alias("b"), *[F.col(f).alias(f"b_{f}") for f in _FIELDS])
    return pairs.join(left, "a").join(right, "b").where(is_same_place()).select("a", "b")


def same_location(profiles: DataFrame) -> DataFrame:
    """(profile_id_a, profile_id_b), smaller first: rows whose differing address texts denote the same location.

    Rows with a null or blank address take part in no pair, nor do rows with the very same text. An address
    without a house number or a street is not located and pairs with none. An empty table gives no rows, a
    profile_id that occurs twice does not pair with itself.
    """
    rows = cut_lineage(profiles.select(F.col("profile_id").cast("bigint").alias("profile_id"), "mailing_address", "mailing_city"))
    places = cut_lineage(located(rows))
    links = place_links(places)
    usable = places.where("number <> '' and street <> ''").select("place").distinct()
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(usable.select(F.col("place").alias("a"), F.col("place").alias("b")))
    texts = places.select("place", "mailing_address", "mailing_city")
    matched = (
        both.join(texts.select(F.col("place").alias("a"), F.col("mailing_address").alias("ta"), F.col("mailing_city").alias("ca")), "a")
        .join(texts.select(F.col("place").alias("b"), F.col("mailing_address").alias("tb"), F.col("mailing_city").alias("cb")), "b")
        .where("ta < tb")
        .select("ta", "ca", "tb", "cb")
    )
    # The rows of a text are dealt out where it is hot, and the partners of the text are copied to them.
    known = rows.where(F.col("mailing_address").isNotNull())
    a = known.select(F.col("profile_id").alias("x"), F.col("mailing_address").alias("ta"), F.col("mailing_city").alias("ca_"))
    b = known.select(F.col("profile_id").alias("y"), F.col("mailing_address").alias("tb"), F.col("mailing_city").alias("cb_"))
    first = salted_join(a, matched, ["ta"], F.col("x"), SALT).where(F.col("ca").eqNullSafe(F.col("ca_"))).select("x", "tb", "cb")
    out = salted_join(b, first, ["tb"], F.col("y"), SALT).where(F.col("cb").eqNullSafe(F.col("cb_")) & (F.col("x") != F.col("y")))
    return out.select(F.least("x", "y").alias("profile_id_a"), F.greatest("x", "y").alias("profile_id_b"))


def place_classes(profiles: DataFrame) -> DataFrame:
    """(profile_id, place, n_links) of every row whose address is located.

    place is the smallest profile_id of the class of rows that links connect, n_links the number of other ways
    to write the row's own address that are linked with it directly.
    """
    rows = cut_lineage(profiles.select(F.col("profile_id").cast("bigint").alias("profile_id"), "mailing_address", "mailing_city"))
    places = cut_lineage(located(rows)).where("number <> '' and street <> ''")
    texts = places.select("place", F.col("mailing_address").alias("text"), F.col("mailing_city").alias("city"))
    hit = (F.col("r.mailing_address") == F.col("t.text")) & F.col("r.mailing_city").eqNullSafe(F.col("t.city"))
    placed = cut_lineage(rows.alias("r").join(texts.alias("t"), hit).select("r.profile_id", "t.place"))
    number = placed.groupBy("place").agg(F.min("profile_id").alias("node"))
    links = cut_lineage(place_links(places))
    ids = links.join(number.withColumnsRenamed({"place": "a", "node": "x"}), "a").join(number.withColumnsRenamed({"place": "b", "node": "y"}), "b")
    labels = components(ids.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
    degree = links.select(F.explode(F.array("a", "b")).alias("place")).groupBy("place").agg(F.count("*").alias("n_links"))
    classes = number.join(labels, "node", "left").join(degree, "place", "left").select("place", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    return salted_join(placed, classes, ["place"], F.col("profile_id"), SALT).select("profile_id", F.col("label").alias("place"), "n_links")
