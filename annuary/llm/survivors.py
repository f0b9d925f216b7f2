"""One surviving record per printed entry: grouping of repeated extractions and field-by-field survivorship.

Rows of one entry lie on the same or the next page, come from different passes, bear names that can be the
same, and agree in their dated records. Two rows of one entry share at least AGREEMENT of the records of the
one with fewer, so this one looks for as many of its records as cannot all be missing, on its page and the
pages beside it; a row without records looks for its initial and the ends of its surname. Rows that are copies
in all their content are one node from the start and hang on it as a star. The survivor of every group comes from a single aggregation: for each field the greatest
struct (filled, completeness, trust of the source, time, value) wins.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.llm import addresses
from annuary.llm.canonical import plain_subject
from annuary.llm.classes import components
from annuary.llm.names import selections
from annuary.llm.orgnames import edit_distance, fold
from annuary.session import cut_lineage, hot_keys, salted_join

#: Honorifics before given names.
HONORIFICS = ["dr", "prof", "gen", "col", "maj", "capt", "lieut", "lt", "rev", "hon", "sir", "mr", "mrs", "miss", "ms", "judge", "sen", "gov", "pres", "adm", "cmdr", "bp", "dean"]
#: Sources, the most trusted first.
TRUST = ["hand", "batch", "live"]
#: Over how many parts the copies of a row that very many rows are copies of are spread.
SALT = 32
#: Rows of a page from which it is crowded, be it that its number stands for many pages; a printed page has some dozens.
#: It decides by which keys pairs are looked up, not which pairs are found.
CROWD = 1_000
#: Edits that two surnames may have if their rows do not share nearly all records.
EDITS = 2
#: Share of the smaller row's dated records that two rows of one entry have in common, at least.
AGREEMENT = 0.5

_HONORIFIC = r"(?i)(?<![\p{L}(])(" + "|".join(HONORIFICS) + r")\b(?:\.?(?=\s)|\.$)"
#: Content that tells copies from mere variants; everything but identity, pass and source.
CONTENT = ["full_name", "titles", "mailing_address", "mailing_city", "mailing_state", "mailing_country", "star_status", "department", "birth_place", "birth_city", "birth_state", "birth_country", "birth_date", "birth_year", "education", "employment", "minor_positions", "societies", "research_accomplished", "research_in_progress"]


def name_parts(name: str | None) -> tuple[str, list[str]]:
    """(surname, given words) in plain lower case; honorifics and brackets are gone."""
    if not name or not name.strip():
        return "", []
    text = re.sub(r"\s+", " ", name).strip()
    if "," in text:
        sur, given = text.split(",", 1)
    else:
        given, _, sur = text.rpartition(" ")
    words = [fold(w).strip(".,") for w in given.replace("(", "").replace(")", "").replace(".", ". ").split()]
    return fold(sur).strip("., "), [w for w in words if w and w not in HONORIFICS]


def names_agree(a: tuple[str, list[str]], b: tuple[str, list[str]], edits: int) -> bool:
    """Surnames within edits; given words agree as far as both go, an initial agreeing with any word it begins."""
    if edit_distance(a[0], b[0]) > edits:
        return False
    for p, q in zip(a[1], b[1], strict=False):
        if p[:1] != q[:1] or (len(p) > 1 and len(q) > 1 and edit_distance(p, q) > 2):
            return False
    return True


def same_by_details(a: dict, b: dict) -> bool:
    """Whether two rows, one of which has no dated records, are extractions of one printed entry."""
    x, y = name_parts(a["full_name"]), name_parts(b["full_name"])
    if not x[0] or not y[0] or not names_agree(x, y, 2):
        return False
    score = 0
    p, q = addresses.parse(a["mailing_address"], a["mailing_city"]), addresses.parse(b["mailing_address"], b["mailing_city"])
    if p and q:
        score += 2 if addresses.same_place(p, q) else -2
    if a["birth_date"] and b["birth_date"]:
        score += 2 if a["birth_date"] == b["birth_date"] else -1
    elif pd.notna(a["birth_year"]) and pd.notna(b["birth_year"]):
        score += 1 if a["birth_year"] == b["birth_year"] else -1
    d, e = plain_subject(a["department"] or ""), plain_subject(b["department"] or "")
    if d and e:
        score += 1 if edit_distance(d, e) <= 2 else -2
    if a["birth_place"] and b["birth_place"]:
        score += 1 if edit_distance(fold(a["birth_place"]), fold(b["birth_place"])) <= 3 else -1
    if a["research_accomplished"] and b["research_accomplished"]:
        score += 1 if a["research_accomplished"] == b["research_accomplished"] else 0
    return score >= 1


_DETAILS = ["full_name", "mailing_address", "mailing_city", "department", "birth_date", "birth_year", "birth_place", "research_accomplished"]


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sides = []
        for s in ("x", "y"):
            part = batch[[f"{s}_{c}" for c in _DETAILS]].copy()
            part.columns = _DETAILS
            sides.append(part.astype(object).where(part.notna(), None).to_dict("records"))
        keep = [same_by_details(a, b) for a, b in zip(*sides, strict=True)]
        yield batch.loc[keep, ["x", "y"]]


def _records() -> Column:
    """The dated degrees and jobs of a row, as hashes of their texts."""

    def texts(field: str, label: str, year: str) -> Column:
        dated = F.filter(F.coalesce(F.col(field), F.array()), lambda x: x.isNotNull() & x[year].isNotNull())
        return F.transform(dated, lambda x: F.xxhash64(F.lit(field), F.coalesce(x[label], F.lit("")), x[year]))

    return F.array_sort(F.array_distinct(F.concat(texts("education", "degree_type", "year"), texts("employment", "position_title", "start_year"))))


def _plain_letters() -> tuple[str, str]:
    """Accented letters and the plain ones they stand for, by the rule of canonical decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x180)]
    pairs = [(a, b) for a, b in pairs if a != b and b.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def with_name_parts(rows: DataFrame) -> DataFrame:
    """rows with sur, given (words without honorifics) and initial, as name_parts takes a name apart."""
    flat = F.regexp_replace(F.translate(F.coalesce("full_name", F.lit("")), *_plain_letters()), r"\p{M}|['’`]", "")
    flat = F.trim(F.regexp_replace(F.lower(flat), r"(?U)\s+", " "))
    comma = F.instr("_flat", ",") > 0
    trimmed = lambda c: F.regexp_replace(c, r"^[., ]+|[., ]+$", "")
    sur = F.when(comma, F.substring_index("_flat", ",", 1)).otherwise(F.substring_index("_flat", " ", -1))
    rest = F.when(comma, F.regexp_extract("_flat", "^[^,]*,(.*)$", 1)).otherwise(F.regexp_extract("_flat", "^(.*) [^ ]*$", 1))
    words = F.split(F.replace(F.regexp_replace(rest, "[()]", ""), F.lit("."), F.lit(". ")), " ")
    given = F.filter(F.transform(words, trimmed), lambda w: (w != "") & ~w.isin(HONORIFICS))
    out = rows.withColumn("_flat", flat).withColumn("sur", trimmed(sur)).withColumn("given", given).drop("_flat")
    return out.withColumn("initial", F.coalesce(F.substring(F.get("given", 0), 1, 1), F.lit("")))


def _given_agree(a: Column, b: Column) -> Column:
    """As far as both go, given words begin alike, and longer ones are within two edits."""
    n = F.least(F.size(a), F.size(b))
    both = F.arrays_zip(F.slice(a, 1, n).alias("p"), F.slice(b, 1, n).alias("q"))
    fits = lambda z: (F.substring(z["p"], 1, 1) == F.substring(z["q"], 1, 1)) & ((F.length(z["p"]) == 1) | (F.length(z["q"]) == 1) | (F.levenshtein(z["p"], z["q"]) <= 2))
    return (n == 0) | F.forall(both, fits)


def _apart() -> Column:
    """Whether some pass lists both nodes at different places, so that they are two entries."""
    return F.arrays_overlap("x_passes", "y_passes") & ~F.arrays_overlap("x_places", "y_places")


def _surname_keys(label: str, choices: list[tuple[int, int, int]]) -> Column:
    """Array of the label with each of the choices (longer by, segment, shift) of substrings that sur has.

    Two surnames within EDITS share a key if one takes its own segments, the other its selections. Empty segments
    of short surnames count, so that none of them is missed.
    """

    def key(x: Column) -> Column:
        n = F.length("sur") - x["d"]
        begin, end = (F.floor(i * n / (EDITS + 1)).cast("int") for i in (x["i"], x["i"] + 1))
        exists = (n > 0) & (begin + x["s"] >= 0) & (end + x["s"] <= F.length("sur"))
        return F.when(exists, F.concat(F.lit(label), F.concat_ws(":", n.cast("string"), x["i"].cast("string"), F.col("sur").substr(begin + x["s"] + 1, end - begin))))

    fixed = F.array(*[F.named_struct(F.lit("d"), F.lit(d), F.lit("i"), F.lit(i), F.lit("s"), F.lit(shift)) for d, i, shift in choices])
    return F.array_compact(F.transform(fixed, key))


def _more(looks: bool) -> Column:
    """What a row of a crowded page is looked up by together with a record, or held under: each of its other records,
    its initial and, where one of two rows has no given name and they share one record only, its surname.

    Of two rows that share one record the one with fewer has two at most, and neither surname is missing.
    """
    own, near = [(0, i, 0) for i in range(EDITS + 1)], selections(EDITS)
    none = F.array().cast("array<string>")
    others = F.transform(F.filter("records", lambda r: r != F.col("record")), lambda r: r.cast("string"))
    initial = F.when(F.col("initial") != "", F.array(F.concat(F.lit("i"), F.col("initial")))).otherwise(none)
    # e: the row that looks has no given name; f: only the one that is held.
    if looks:
        surname = F.when(F.col("initial") == "", _surname_keys("e", near)).otherwise(_surname_keys("f", own))
        unnamed = (F.size("records") > 2) | (F.col("sur") == "")
    else:
        surname = F.concat(_surname_keys("e", own), F.when(F.col("initial") == "", _surname_keys("f", near)).otherwise(none))
        unnamed = F.col("sur") == ""
    return F.concat(others, initial, F.when(unnamed, none).otherwise(surname))


def entry_pairs(nodes: DataFrame) -> DataFrame:
    """(x, y): nodes that are extractions of one entry, by their records or else by names and details.

    With common records the names decide: the surname may have two edits and the given words must agree. Where
    nearly all records are common, two at least, one of the names may be missing, the surname may have four
    edits, or the initial may be misread.
    """
    slim = ["passes", "places", "records", "sur", "given"]
    side = lambda s, columns: nodes.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in columns])
    around = F.explode(F.array(F.col("source_page") - 1, F.col("source_page"), F.col("source_page") + 1)).alias("page")
    m = F.size("records")
    needed = F.slice("records", 1, m - F.ceil(m * AGREEMENT).cast("int") + 1)
    crowded = F.broadcast(hot_keys(nodes, ["source_page"], CROWD).select(F.col("source_page").alias("page"), F.lit(True).alias("crowded")))
    # Crowded pages differ in the keys only: what any pair of one entry shares, it shares under one of them.
    finer = lambda looks: F.explode(F.when(F.col("crowded"), _more(looks)).otherwise(F.array(F.lit("")))).alias("more")
    some = nodes.where(m > 0)
    wanted = some.select(F.col("node").alias("x"), m.alias("nx"), "initial", "sur", "records", around, needed.alias("r")).join(crowded, "page", "left").select("*", F.explode("r").alias("record")).select("x", "nx", "page", "record", finer(True))
    held = some.select(F.col("node").alias("y"), m.alias("ny"), "initial", "sur", "records", F.col("source_page").alias("page")).join(crowded, "page", "left").select("*", F.explode("records").alias("record")).select("y", "ny", "page", "record", finer(False))
    fewer = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    pairs = wanted.join(held, ["page", "record", "more"]).where(fewer).select("x", "y").distinct()
    both = pairs.join(side("x", slim), "x").join(side("y", slim), "y").where(~_apart())
    common = F.size(F.array_intersect("x_records", "y_records"))
    share = common / F.size("x_records")
    strong = (share >= 0.8) & (common >= 2)
    edits = F.levenshtein("x_sur", "y_sur")
    agree = _given_agree(F.col("x_given"), F.col("y_given"))
    nameless = (F.col("x_sur") == "") | (F.col("y_sur") == "")
    by_records = both.where((share >= AGREEMENT) & F.when(nameless, strong).otherwise(((edits <= F.when(strong, 4).otherwise(EDITS)) & agree) | (strong & (edits <= EDITS)))).select("x", "y")

    ends = F.explode(F.array(F.concat(F.lit("<"), F.substring("sur", 1, 3)), F.concat(F.lit(">"), F.expr("right(sur, 3)")))).alias("end")
    named = nodes.where("sur <> ''")
    wanted = named.where(m == 0).select(F.col("node").alias("x"), "initial", around, "sur").select("x", "initial", "page", ends)
    held = named.select(F.col("node").alias("y"), m.alias("ny"), "initial", F.col("source_page").alias("page"), "sur").select("y", "ny", "initial", "page", ends)
    pairs = wanted.join(held, ["page", "initial", "end"]).where((F.col("ny") > 0) | (F.col("x") < F.col("y"))).select("x", "y").distinct()
    full = ["passes", "places", *_DETAILS]
    by_details = pairs.join(side("x", full), "x").join(side("y", full), "y").where(~_apart()).drop("x_passes", "y_passes", "x_places", "y_places")
    return by_records.unionByName(by_details.mapInPandas(_verify, "x bigint, y bigint"))


def entry_groups(profiles: DataFrame) -> DataFrame:
    """(profile_id, group_id) of every row; group_id is the smallest profile_id of its printed entry.

    A pass lists an entry at one place only. Rows without page form groups of their own unless they are copies.
    Repeated rows fall together; otherwise a row without a name joins only by its records, two at least.
    """
    rows = profiles.select(F.col("profile_id").cast("bigint").alias("profile_id"), "source_page", "pass_no", "pos", *CONTENT)
    content = F.unhex(F.md5(F.to_json(F.struct("source_page", *CONTENT))))
    marked = cut_lineage(rows.select("profile_id", "pass_no", "pos", content.alias("content")))
    # Of the copies in one pass the first place stands for all, so that what is collected is bounded by the passes.
    by_pass = marked.groupBy("content", "pass_no").agg(F.min("profile_id").alias("node"), F.concat_ws(":", "pass_no", F.min("pos")).alias("place"))
    first = by_pass.groupBy("content").agg(F.min("node").alias("node"), F.collect_set("pass_no").alias("passes"), F.collect_set("place").alias("places"))
    members = cut_lineage(salted_join(marked.select("profile_id", "content"), first, ["content"], F.col("profile_id"), SALT).select("profile_id", "node", "passes", "places"))
    own = rows.select("profile_id", "source_page", _records().alias("records"), *_DETAILS)
    nodes = cut_lineage(with_name_parts(own.join(members.where("profile_id = node"), "profile_id")))
    labels = components(entry_pairs(nodes))
    return salted_join(members.select("profile_id", "node"), labels, ["node"], F.col("profile_id"), SALT, "left").select("profile_id", F.coalesce("label", "node").alias("group_id"))


def trust(via: Column) -> Column:
    """Rank of a source, higher is more trusted; an unknown or null source has the lowest."""
    out = F.lit(0)
    for i, source in enumerate(reversed(TRUST), start=1):
        out = F.when(via == source, F.lit(i)).otherwise(out)
    return out


def letters(name: Column) -> Column:
    """Letters of a name without its honorifics; 0 for null."""
    return F.length(F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), _HONORIFIC, ""), r"[^\p{L}]", ""))


def survivors(profiles: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per group: its size, and for full_name and birth_year the surviving value and the row it is from.

    full_name comes from the row with most letters, birth_year from any row that has one; further choice is
    by trust, then the later extraction, then the smaller profile_id. Where no row has the field, value is
    null and the row 0.
    """
    needed = profiles.select(F.col("profile_id").cast("bigint").alias("profile_id"), "full_name", "birth_year", "via", "extracted_at")
    rows = needed.join(groups, "profile_id")
    rank = [trust(F.col("via")).alias("trust"), F.col("extracted_at").alias("at"), (-F.col("profile_id")).alias("row")]
    name = F.max(F.struct(letters(F.col("full_name")).alias("n"), *rank, F.col("full_name").alias("value")))
    birth = F.max(F.when(F.col("birth_year").isNotNull(), F.struct(*rank, F.col("birth_year").alias("value"))))
    best = rows.groupBy("group_id").agg(F.count("*").alias("n_rows"), name.alias("name"), birth.alias("birth"))
    return best.select(
        "group_id",
        "n_rows",
        F.col("name.value").alias("full_name"),
        F.when(F.col("name.n") > 0, -F.col("name.row")).otherwise(F.lit(0)).alias("name_from"),
        F.col("birth.value").alias("birth_year"),
        F.coalesce(-F.col("birth.row"), F.lit(0)).alias("birth_from"),
    )
