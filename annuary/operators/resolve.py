"""Union of repeated passes over a page by fuzzy one-to-one matching of names."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher, get_close_matches

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from annuary.functions.people import given_initials, name_key, surname
from annuary.functions.text import squash
from annuary.session import cut_lineage, fan_out

#: Least score of a match, what differing initials cost, what an equal birth year earns.
MATCH, INITIALS_COST, BIRTH_BONUS = 0.85, 0.05, 0.10
SCALARS = ["full_name", "titles", "mailing_address", "mailing_city", "mailing_state", "mailing_country", "department", "birth_place", "birth_city", "birth_state", "birth_country", "birth_date", "research_accomplished", "research_in_progress"]
LISTS = ["education", "employment", "minor_positions", "societies"]


def richness(profiles: DataFrame) -> Column:
    """Filled scalar fields plus the lengths of the lists; false and 0 count as empty."""
    n = F.coalesce(F.col("star_status"), F.lit(False)).cast("int") + (F.coalesce(F.col("birth_year"), F.lit(0)) != 0).cast("int")
    for c in SCALARS:
        n = n + (F.coalesce(F.col(c), F.lit("")) != "").cast("int")
    for c in LISTS:
        n = n + F.coalesce(F.size(c), F.lit(0)) * F.col(c).isNotNull().cast("int")
    return n


def likeness(left: Column, right: Column) -> Column:
    """The ratio of equal letters of two keys, by the longest blocks they share; null unless it may reach MATCH.

    A bonus may still lift a ratio that is a little lower, so the bound leaves room for it. The cheap upper bounds
    of the ratio spare most comparisons and change no result.
    """

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        least = MATCH - BIRTH_BONUS - 1e-9
        matcher = SequenceMatcher(None)
        out = []
        for x, y in zip(a, b, strict=True):
            matcher.set_seqs(x, y)
            out.append(matcher.ratio() if matcher.real_quick_ratio() >= least and matcher.quick_ratio() >= least else None)
        return pd.Series(out, dtype="float64")

    return ratio(left, right)


def pass_scores(entries: DataFrame) -> DataFrame:
    """(source_page, x, y, score) of all entries x and y of a page, y of a later pass, whose names make a match.

    Entries without a name match none. Pairs of equal names are told without a comparison of letters.
    """
    named = entries.where("key <> ''").select("source_page", "profile_id", "nth", "key", "initials", "birth_year")
    x = named.select("source_page", *[F.col(c).alias(f"x_{c}") for c in named.columns[1:]])
    y = named.select("source_page", *[F.col(c).alias(f"y_{c}") for c in named.columns[1:]])
    pairs = x.join(y, "source_page").where("x_nth < y_nth")
    # As many letters as the shorter key has can be equal at most.
    short = F.least(F.length("x_key"), F.length("y_key")) * 2.0 / (F.length("x_key") + F.length("y_key"))
    close = pairs.where(short >= MATCH - BIRTH_BONUS - 1e-9)
    keys = close.where("x_key <> y_key").select("x_key", "y_key").distinct()
    ratios = fan_out(keys).withColumn("ratio", likeness(F.col("x_key"), F.col("y_key"))).where("ratio is not null")
    same = F.when(F.col("x_key") == F.col("y_key"), F.lit(1.0))
    differ = (F.col("x_initials") != "") & (F.col("y_initials") != "") & (F.col("x_initials") != F.col("y_initials"))
    born = (F.coalesce("x_birth_year", F.lit(0)) != 0) & F.coalesce(F.col("x_birth_year") == F.col("y_birth_year"), F.lit(False))
    score = F.coalesce(same, "ratio") + (F.when(differ, -INITIALS_COST).otherwise(0.0) + F.when(born, BIRTH_BONUS).otherwise(0.0))
    scored = close.join(ratios, ["x_key", "y_key"], "left").withColumn("score", score).where(F.col("score") >= MATCH)
    return scored.select("source_page", F.col("x_profile_id").alias("x"), F.col("y_profile_id").alias("y"), "score")


def settle(score: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one pairs (row, column) of a matrix of scores, 0 where there is no match.

    In every round those pairs are taken that are the best of their row and of their column; among equal scores
    the first row, then the first column counts as better. The best pair of all that are left is always such a
    pair, and no pair that is taken stands in the way of a better one, so this ends in the same pairs as taking
    the best one at a time.
    """
    score = score.copy()
    pairs = []
    while score.size and score.max() > 0:
        of_row, of_column = score.argmax(axis=1), score.argmax(axis=0)
        taken = [(i, j) for i, j in enumerate(of_row.tolist()) if score[i, j] > 0 and of_column[j] == i]
        pairs += taken
        for i, j in taken:
            score[i, :] = 0
            score[:, j] = 0
    return pairs


def merge_passes(profiles: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(source_page, ordinal, profile_id): the surviving rows of every page, in order.

    Names are compared in a join of the entries of a page; what is left to settle page by page are numbers. Each
    pass is matched with what the passes before it left, every entry once. Of two matched entries the one whose
    surname alone the page prints stays, else the richer, else the earlier; it keeps the place. Pages with one
    pass keep their rows without leaving the JVM. A page is a piece of print with a bounded number of entries and
    passes. An unknown pass or place comes first.
    """
    order = [F.coalesce("pass_no", F.lit(-1)), F.coalesce("pos", F.lit(-1)), F.col("profile_id")]
    slim = profiles.select(
        "source_page", "profile_id", "pass_no", "pos", name_key(F.col("full_name")).alias("key"), given_initials(F.coalesce("full_name", F.lit(""))).alias("initials"), "birth_year",
        richness(profiles).alias("richness"), surname(F.col("full_name")).alias("s"),
    )
    slim = slim.withColumn("nth", F.dense_rank().over(Window.partitionBy("source_page").orderBy(order[0])))
    if pages is None:
        slim = slim.withColumn("printed", F.lit(False)).drop("s")
    else:
        text = pages.select(F.col("page").alias("source_page"), squash(F.col("text")).alias("t"))
        slim = slim.join(text, "source_page", "left").withColumn("printed", F.coalesce((F.col("s") != "") & F.contains("t", F.concat("s", F.lit(","))), F.lit(False))).drop("s", "t")
    slim = cut_lineage(slim)
    several = slim.join(slim.where("nth > 1").select("source_page").distinct(), "source_page", "left_semi")
    single = slim.join(slim.where("nth > 1").select("source_page").distinct(), "source_page", "left_anti")
    rank = F.struct(order[0].alias("a"), order[1].alias("b"), "profile_id", "nth", "richness", "printed")
    entries = several.groupBy("source_page").agg(F.sort_array(F.collect_list(rank)).alias("e"))  # a page of print
    scores = pass_scores(several).groupBy("source_page").agg(F.collect_list(F.struct("x", "y", "score")).alias("m"))
    joined = entries.join(scores, "source_page", "left").select(
        "source_page", "e.profile_id", "e.nth", "e.richness", "e.printed", F.col("m.x").alias("x"), F.col("m.y").alias("y"), F.col("m.score").alias("score")
    )

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                matches = {} if r.x is None else {(a, b): s for a, b, s in zip(r.x.tolist(), r.y.tolist(), r.score.tolist(), strict=True)}
                rows += [(r.source_page, i, k) for i, k in enumerate(kept_entries(r.profile_id.tolist(), r.nth.tolist(), r.richness.tolist(), r.printed.tolist(), matches))]
            yield pd.DataFrame(rows, columns=["source_page", "ordinal", "profile_id"])

    folded = fan_out(joined, "source_page").mapInPandas(fold, "source_page int, ordinal int, profile_id bigint")
    first = F.row_number().over(_print_order()) - 1
    return single.select("source_page", first.alias("ordinal"), "profile_id").unionByName(folded)


def kept_entries(ids: list[int], nth: list[int], rich: list[int], printed: list[bool], matches: dict[tuple[int, int], float]) -> list[int]:
    """The entries of one page that are left when each pass is matched with what is there, in their order."""
    better = {i: (bool(p), r) for i, p, r in zip(ids, printed, rich, strict=True)}
    kept: list[int] = []
    for n in sorted(set(nth)):
        new = [i for i, k in zip(ids, nth, strict=True) if k == n]
        score = np.array([[matches.get((a, b), 0.0) for b in new] for a in kept]).reshape(len(kept), len(new))
        pairs = settle(score)
        for i, j in pairs:
            if better[new[j]] > better[kept[i]]:
                kept[i] = new[j]
        matched = {j for _, j in pairs}
        kept += [b for j, b in enumerate(new) if j not in matched]
    return kept


def _print_order() -> WindowSpec:
    return Window.partitionBy("source_page").orderBy("pass_no", "pos", "profile_id")


def close_matches(words: DataFrame, references: list[str], cutoff: float = 0.75) -> DataFrame:
    """(word, match): the likest reference for every distinct word, null if none reaches the cutoff.

    references is a small closed list known to the caller; ties go to the alphabetically last.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [get_close_matches(w, references, n=1, cutoff=cutoff) for w in b["word"]]
            yield pd.DataFrame({"word": b["word"], "match": [f[0] if f else None for f in found]})

    return words.where("word is not null").select("word").distinct().mapInPandas(find, "word string, match string")
