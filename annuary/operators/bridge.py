"""Places of institutions: counts, votes of mailing addresses, the bridge table and its application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.functions.text import null_to_blank, strip, tokens
from annuary.session import cut_lineage, numbered

#: Words that may follow an institution's name inside an address segment.
GENERIC_WORDS = (
    "university univ college col institute institution inst school sch academy acad co company corp works hospital hosp "
    "laboratory lab station sta park museum library foundation fund observatory garden gardens herbarium seminary sem"
).split()
#: Kinds of organisation a proposal may locate, and kinds that stay blank.
LOCATABLE = ["university", "college", "government", "company", "hospital", "museum", "observatory", "other_institution"]
BLANK_KINDS = ["not_a_place", "ambiguous"]
MAJORITY = 0.6
PLACE_COLUMNS = ["city", "state_region", "country"]
ENRICHED = ["institution_city", "institution_state_region", "institution_country", "institution_location_source"]


def institution_mentions(profiles: DataFrame) -> DataFrame:
    """One row per mention of an institution in the three lists, stripped, blanks left out."""
    lists = F.concat(
        F.coalesce(F.transform("education", lambda x: x["institution"]), F.array().cast("array<string>")),
        F.coalesce(F.transform("employment", lambda x: x["institution_org"]), F.array().cast("array<string>")),
        F.coalesce(F.transform("minor_positions", lambda x: x["institution_org"]), F.array().cast("array<string>")),
    )
    return profiles.select(F.explode(lists).alias("institution")).select(strip(F.col("institution")).alias("institution")).where("institution <> ''")


def institution_counts(profiles: DataFrame) -> DataFrame:
    return institution_mentions(profiles).groupBy("institution").agg(F.count("*").alias("n_events"))


def address_segments(profiles: DataFrame) -> DataFrame:
    """Comma segments of locatable addresses that are more than the place itself: tokens and place, equal ones counted."""
    clean = lambda c: strip(F.coalesce(F.col(c), F.lit("")))
    rows = profiles.select(
        clean("mailing_city").alias("city"), clean("mailing_state").alias("state_region"), clean("mailing_country").alias("country"), clean("mailing_address").alias("address")
    ).where("city <> '' and address <> ''")
    geo = F.concat(tokens(F.col("city")), tokens(F.col("state_region")), tokens(F.col("country")))
    parts = rows.select(*PLACE_COLUMNS, geo.alias("geo"), F.explode(F.split("address", ",")).alias("part")).select(*PLACE_COLUMNS, "geo", tokens(F.col("part")).alias("seg"))
    kept = parts.where((F.size("seg") > 0) & F.exists("seg", lambda t: ~F.array_contains(F.col("geo"), t)))
    return kept.groupBy(*PLACE_COLUMNS, "seg").agg(F.count("*").alias("votes"))


def segment_matches(name: Column, seg: Column) -> Column:
    """Whether the name's tokens begin the segment's tokens in order from the first offset where they all do, with only generic words after."""
    n = F.size(name)
    offsets = F.when(F.size(seg) >= n, F.sequence(F.lit(0), F.size(seg) - n)).otherwise(F.array().cast("array<int>"))
    fits = F.filter(offsets, lambda o: F.forall(F.arrays_zip(name.alias("n"), F.slice(seg, o + 1, n).alias("s")), lambda z: F.startswith(z["s"], z["n"])))
    at = F.get(fits, 0)
    return at.isNotNull() & F.forall(F.slice(seg, at + n + 1, F.greatest(F.size(seg), F.lit(1))), lambda t: t.isin(GENERIC_WORDS))


def address_votes(profiles: DataFrame) -> DataFrame:
    """(institution, place, votes) by the theta join of names and address segments.

    The first four letters of any token of a name are those of a token of the segment, if the token is that long;
    those of the first token in any case. Each name waits under the one of these blocks that the fewest different
    segments have, so names that begin alike ('University of ...') do not meet every segment with such a word.
    Equal segments vote together, so a place that a third of all rows share is one row of the join.
    """
    names = institution_counts(profiles).select("institution", tokens(F.col("institution")).alias("name")).where("size(name) > 0 and aggregate(name, 0, (a, t) -> a + length(t)) >= 4")
    head = lambda t: F.substring(t, 1, 4)
    segments = cut_lineage(address_segments(profiles))
    right = segments.withColumn("block", F.explode(F.array_distinct(F.transform("seg", head))))
    sizes = right.groupBy("block").agg(F.count("*").alias("n"))
    first = head(F.get("name", 0))
    usable = F.array_distinct(F.concat(F.array(first), F.transform(F.filter("name", lambda t: F.length(t) >= 4), head)))
    # A name one of whose blocks no segment has can match none.
    asked = names.select("institution", F.explode(usable).alias("block")).join(sizes, "block", "left")
    rarest = asked.groupBy("institution").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "block")).alias("m")).where("m.n > 0").select("institution", "m.block")
    left = names.join(rarest, "institution")
    hits = left.join(right, "block").where(F.exists("seg", lambda t: head(t) == first) & segment_matches(F.col("name"), F.col("seg")))
    return hits.groupBy("institution", *PLACE_COLUMNS).agg(F.sum("votes").alias("votes"))


def address_evidence(profiles: DataFrame, majority: float = MAJORITY) -> DataFrame:
    """(institution, place, n_top, n_total) where one place has the majority of the votes; a tie cannot."""
    top = address_votes(profiles).groupBy("institution").agg(
        F.max(F.struct("votes", *PLACE_COLUMNS)).alias("top"), F.sum("votes").alias("n_total")
    )
    return top.where(F.col("top.votes") / F.col("n_total") >= majority).select("institution", *[F.col(f"top.{c}").alias(c) for c in PLACE_COLUMNS], F.col("top.votes").alias("n_top"), "n_total")


def vote_note(n_top: Column, n_total: Column) -> Column:
    return F.when(n_top == n_total, F.format_string("auto: %d mailing address(es), unanimous", n_total)).otherwise(F.format_string("auto: %d of %d mailing addresses", n_top, n_total))


def no_place(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns or PLACE_COLUMNS:
        out = out & (F.coalesce(F.col(c), F.lit("")) == "")
    return out


def refresh_bridge(bridge: DataFrame, profiles: DataFrame) -> DataFrame:
    """Existing rows with fresh counts, then new institutions; rows without any place take the address evidence.

    A filled cell is never overwritten. Nulls count as blanks.
    """
    old = bridge.select("institution", *[null_to_blank(F.col(c)).alias(c) for c in [*PLACE_COLUMNS, "notes"]]).withColumn("key", strip(F.coalesce("institution", F.lit(""))))
    counts = institution_counts(profiles).withColumnRenamed("institution", "key")
    new = counts.join(old.select("key").distinct(), "key", "left_anti").select("key", F.col("key").alias("institution"), *[F.lit("").alias(c) for c in [*PLACE_COLUMNS, "notes"]])
    rows = old.unionByName(new).join(counts, "key", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))
    found = address_evidence(profiles).select(F.col("institution").alias("key"), *[F.col(c).alias(f"e_{c}") for c in PLACE_COLUMNS], "n_top", "n_total")
    joined = rows.join(found, "key", "left")
    take = no_place() & F.col("n_total").isNotNull()
    return joined.select(
        "institution",
        "n_events",
        *[F.when(take, F.col(f"e_{c}")).otherwise(F.col(c)).alias(c) for c in PLACE_COLUMNS],
        F.when(take, vote_note(F.col("n_top"), F.col("n_total"))).otherwise(F.col("notes")).alias("notes"),
    )


def source_of(notes: Column) -> Column:
    n = strip(F.coalesce(notes, F.lit("")))
    return F.when(n.startswith("auto:"), "mailing address").when(n.startswith("ai:"), "AI").otherwise("hand")


def location_lookup(bridge: DataFrame, order: str = "bridge_id") -> DataFrame:
    """One place per institution: the first row in the given order that has any part of a place."""
    rows = bridge.select(
        strip(null_to_blank(F.col("institution"))).alias("institution"), *[F.nullif(strip(null_to_blank(F.col(c))), F.lit("")).alias(c) for c in PLACE_COLUMNS], source_of(F.col("notes")).alias("source"), order
    ).dropna(how="all", subset=PLACE_COLUMNS)
    first = F.min_by(F.struct(*PLACE_COLUMNS, "source"), F.col(order)).alias("p")
    return rows.groupBy("institution").agg(first).select("institution", "p.*")


def apply_locations(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """Events with the place of their institution, matched letter by letter; columns of an earlier run are replaced.

    The events are not shuffled: a lookup within the broadcast threshold is broadcast by Spark itself.
    """
    fresh = events.drop(*ENRICHED, "n_events", "notes")
    renamed = lookup.select(
        F.col("institution").alias("institution_organization"), *[F.col(a).alias(b) for a, b in zip([*PLACE_COLUMNS, "source"], ENRICHED, strict=True)]
    )
    return fresh.join(renamed, "institution_organization", "left")


def location_stats(bridge: DataFrame) -> DataFrame:
    """Rows and events of the bridge by source of the place, and the share of events that have one."""
    rows = bridge.select(F.coalesce("n_events", F.lit(0)).alias("n"), no_place().alias("blank"), source_of(F.col("notes")).alias("source"))
    of = lambda s: ~F.col("blank") & (F.col("source") == s)
    total, located = F.sum("n").cast("bigint"), F.sum(F.when(~F.col("blank"), F.col("n")).otherwise(0)).cast("bigint")
    out = [F.count("*").alias("n_inst"), F.sum((~F.col("blank")).cast("bigint")).alias("n_inst_coded"), F.sum(F.col("blank").cast("bigint")).alias("n_blank")]
    for name, s in (("mail", "mailing address"), ("ai", "AI"), ("hand", "hand")):
        out += [F.sum(of(s).cast("bigint")).alias(f"n_{name}_rows"), F.sum(F.when(of(s), F.col("n")).otherwise(0)).cast("bigint").alias(f"n_{name}_events")]
    out += [F.format_string("%.1f%% of events", 100.0 * located / F.greatest(total, F.lit(1))).alias("inst_coverage"), located.alias("located_events"), total.alias("all_events")]
    return rows.agg(*out)


def propose_targets(bridge: DataFrame, min_events: int = 20, batch: int = 25) -> DataFrame:
    """Rows without a place, common enough and not proposed before, in batches of the most frequent first.

    The ordinal is dense over all rows; rows are sorted in ranges, and each range counts on from those before it.
    """
    wanted = bridge.where(no_place() & (F.coalesce("n_events", F.lit(0)) >= min_events) & ~F.coalesce(F.col("notes").startswith("ai:"), F.lit(False)))
    placed = numbered(wanted.select("bridge_id", "institution", "n_events"), [F.desc("n_events"), F.asc("institution"), F.asc("bridge_id")])
    return placed.select("bridge_id", "institution", "n_events", "ordinal", F.floor((F.col("ordinal") - 1) / batch).alias("batch_no"))


def accept_proposals(replies: DataFrame, wanted: DataFrame) -> DataFrame:
    """Replies matched to the wanted institutions, exactly or else by lower case, with the fields to be filled in.

    Unconfident replies and blank kinds fill nothing; a kind that cannot be located or a missing country fails.
    """
    clean = lambda c: strip(null_to_blank(F.col(c)))
    r = replies.select(clean("institution").alias("asked"), clean("kind").alias("kind"), F.coalesce("confident", F.lit(False)).alias("confident"), *[clean(c).alias(f"r_{c}") for c in PLACE_COLUMNS], clean("resolved_name").alias("resolved"), "reply_id")
    exact = wanted.select(F.col("institution").alias("hit"))
    lower = wanted.groupBy(F.lower("institution").alias("low")).agg(F.min("institution").alias("near"))
    joined = r.join(exact, F.col("asked") == F.col("hit"), "left").join(lower, F.lower("asked") == F.col("low"), "left").withColumn("institution", F.coalesce("hit", "near")).where("institution is not null")
    skip = F.col("kind").isin(BLANK_KINDS) | ~F.col("confident")
    fail = ~F.col("kind").isin(LOCATABLE) | (F.col("r_country") == "")
    name = F.coalesce(F.nullif("resolved", F.lit("")), F.col("institution"))
    kind = F.coalesce(F.nullif("kind", F.lit("")), F.lit("unclassified"))
    note = (
        F.when(skip, F.concat(F.lit("ai: "), name, F.lit(" | "), kind, F.lit(" | not filled")))
        .when(fail, F.concat(F.lit("ai: "), name, F.lit(" | "), kind, F.lit(" | failed check (need country + locatable kind)")))
        .otherwise(F.concat(F.lit("ai: "), name, F.lit(" | "), F.col("kind")))
    )
    return joined.select("reply_id", "institution", *[F.when(skip | fail, "").otherwise(F.col(f"r_{c}")).alias(c) for c in PLACE_COLUMNS], note.alias("notes"))


def merge_proposals(bridge: DataFrame, accepted: DataFrame) -> DataFrame:
    """Keyed update of the bridge: a proposal fills a row only while the row has no place."""
    new = accepted.groupBy("institution").agg(F.min_by(F.struct(*PLACE_COLUMNS, "notes"), "reply_id").alias("p"))
    joined = bridge.join(new, "institution", "left")
    take = no_place() & F.col("p").isNotNull()
    return joined.select("bridge_id", "institution", *[F.when(take, F.col(f"p.{c}")).otherwise(F.col(c)).alias(c) for c in [*PLACE_COLUMNS, "notes"]])
