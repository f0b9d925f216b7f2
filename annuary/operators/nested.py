"""Shredding of nested JSON objects into flat tables by Merkle subtree identities.

Every object is canonicalised and hashed bottom-up: its own scalar fields together with the hashes of its
children. An object therefore has one identity wherever it occurs, is stored once in the node table, and
every occurrence is an edge (parent, field, ordinal, child); the record table links each source row to its
root. Flat tables come from joining records, edges and nodes, never from parsing a second time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.session import cut_lineage, salted_join, spread

#: Spread of the records that share one root (copies of one page), for the joins along the tree.
SALT = 8

LISTS = ("education", "employment", "minor_positions", "societies")


#: What stands between the parts of a JSON text, and its numbers and words.
_BLANK = re.compile(r"[ \t\n\r]*")
_PLAIN = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?|true|false|null|NaN|-?Infinity")


def parse_json(text: str) -> object:
    """The value of a JSON text of any depth. ValueError if it is damaged.

    The parser of the standard library is tried first; it gives up on very deep texts, which are then read with
    a stack of our own.
    """
    try:
        return json.loads(text)
    except RecursionError:
        return _parse_deep(text)


def _parse_deep(text: str) -> object:
    open_: list[tuple[object, str | None]] = []  # containers that are not closed yet, each with the key that waits
    at = _BLANK.match(text).end()
    while True:
        mark = text[at : at + 1]
        if mark in ("{", "["):
            value: object = {} if mark == "{" else []
            at = _BLANK.match(text, at + 1).end()
            if text[at : at + 1] != ("}" if mark == "{" else "]"):
                key = None
                if mark == "{":
                    key, at = _key(text, at)
                open_.append((value, key))
                continue
            at += 1
        elif mark == '"':
            value, at = json.decoder.scanstring(text, at + 1, True)
        else:
            plain = _PLAIN.match(text, at)
            if plain is None:
                raise ValueError(f"no value at {at}")
            value, at = json.loads(plain.group()), plain.end()
        # A whole value: hand it to the container around it, and close all that end here.
        while True:
            at = _BLANK.match(text, at).end()
            if not open_:
                if at != len(text):
                    raise ValueError(f"text after the value at {at}")
                return value
            around, key = open_.pop()
            if isinstance(around, dict):
                around[key] = value
            else:
                around.append(value)
            mark = text[at : at + 1]
            if mark == ("}" if isinstance(around, dict) else "]"):
                value, at = around, at + 1
                continue
            if mark != ",":
                raise ValueError(f"no comma at {at}")
            at = _BLANK.match(text, at + 1).end()
            key = None
            if isinstance(around, dict):
                key, at = _key(text, at)
            open_.append((around, key))
            break


def _key(text: str, at: int) -> tuple[str, int]:
    """The key at this place and where its value begins."""
    if text[at : at + 1] != '"':
        raise ValueError(f"no key at {at}")
    key, at = json.decoder.scanstring(text, at + 1, True)
    at = _BLANK.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError(f"no colon at {at}")
    return key, _BLANK.match(text, at + 1).end()


def page_text(raw: str) -> dict | None:
    """The page object of a raw record: the object itself, or the text of a batch result line. None if not whole."""
    try:
        outer = parse_json(raw)
        if not isinstance(outer, dict):
            return None
        if "response" not in outer:
            return outer
        body = (outer.get("response") or {}).get("body") or {}
        text = "".join(
            piece.get("text") or ""
            for message in body.get("output") or []
            for piece in message.get("content") or []
            if piece.get("type") == "output_text"
        )
        start, stop = text.find("{"), text.rfind("}")
        inner = parse_json(text[start : stop + 1]) if start >= 0 else None
        return inner if isinstance(inner, dict) else None
    except (ValueError, AttributeError, TypeError):
        return None


def _parts(value: object, list_fields: frozenset[str]) -> tuple[bytes, str, list[tuple[str, int]], list[object]]:
    """What a value is made of: its sort, the JSON of what it holds itself, and its children with their places."""
    places: list[tuple[str, int]] = []
    children: list[object] = []
    if isinstance(value, dict):
        own: dict[str, object] = {}
        for field in sorted(value):
            inner = value[field]
            if field in list_fields and inner is not None and not isinstance(inner, list):
                inner = [inner]
            if isinstance(inner, dict):
                places.append((field, 0))
                children.append(inner)
            elif isinstance(inner, list) and any(x is not None for x in inner):
                for i, x in enumerate(inner):
                    if x is not None:
                        places.append((field, i))
                        children.append(x)
            else:
                own[field] = inner
        return b"o", json.dumps(own, sort_keys=True, ensure_ascii=False), places, children
    if isinstance(value, list):
        for i, x in enumerate(value):
            if x is not None:
                places.append(("", i))
                children.append(x)
        return b"a", "[]", places, children
    return b"v", json.dumps(value, ensure_ascii=False), places, children


def shred(obj: object, list_fields: frozenset[str], nodes: dict[bytes, str], edges: set[tuple[bytes, str, int, bytes]]) -> bytes:
    """Add obj and everything below to nodes and edges; returns its hash.

    Objects, and the entries of lists, become nodes of their own; a list inside a list is a node whose entries
    hang on the field ''. A field named in list_fields that holds a single value instead of a list counts as a
    list of one. Null entries make no node but keep their ordinal. The walk keeps its own stack, so depth is
    bounded by memory only.
    """
    todo: list[tuple[object, tuple | None]] = [(obj, None)]
    done: list[bytes] = []  # hashes of finished values whose parents are not finished yet
    while todo:
        value, made = todo.pop()
        if made is None:
            sort, content, places, children = _parts(value, list_fields)
            todo.append((None, (sort, content, places)))
            todo += [(x, None) for x in reversed(children)]
            continue
        sort, content, places = made
        links = [(field, i, child) for (field, i), child in zip(places, done[len(done) - len(places) :], strict=True)]
        del done[len(done) - len(places) :]
        digest = hashlib.blake2b(sort + content.encode("utf-8", "surrogatepass"), digest_size=16)
        for field, i, child in links:
            digest.update(f"\x00{field}\x00{i}\x00".encode("utf-8", "surrogatepass") + child)
        key = digest.digest()
        nodes.setdefault(key, content)
        edges.update((key, field, i, child) for field, i, child in links)
        done.append(key)
    return done[0]


_SHREDS = "record_id bigint, source_page int, root binary, node binary, content string, parent binary, field string, ordinal int, child binary"
#: Identities that a task remembers to have handed on already, before it forgets them all; bounds memory only.
_REMEMBER = 400_000


def _shred_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _SHREDS.split(", ")]
    sent: set = set()
    fields = frozenset((*LISTS, "scientists"))
    for batch in batches:
        rows: list[tuple] = []
        for record_id, source_page, raw in zip(batch["record_id"], batch["source_page"], batch["raw_json"], strict=True):
            page = page_text(raw)
            if page is None:
                continue
            nodes: dict[bytes, str] = {}
            edges: set[tuple[bytes, str, int, bytes]] = set()
            root = shred(page, fields, nodes, edges)
            rows.append((record_id, source_page, root, None, None, None, None, None, None))
            rows += [(None, None, None, k, v, None, None, None, None) for k, v in nodes.items() if k not in sent]
            rows += [(None, None, None, None, None, *e) for e in edges if e not in sent]
            sent.update(nodes)
            sent.update(edges)
            if len(sent) > _REMEMBER:
                sent.clear()
        out = pd.DataFrame(rows, columns=names)
        out["record_id"] = out["record_id"].astype("Int64")
        out["source_page"] = out["source_page"].astype("Int32")
        out["ordinal"] = out["ordinal"].astype("Int32")
        yield out


def merkle_tables(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, nodes, edges) of the page_records rows with status ok and whole JSON.

    records: record_id, root. nodes: node, content (JSON of the object's own scalar fields), each identity
    once. edges: parent, field, ordinal (from 0, as written), child, each once. Objects may be nested to any
    depth. Rows with null raw_json or damaged JSON are in none of the tables, but in unread_records.
    """
    roots, nodes, edges = _tables(_ok(records))
    return roots.drop("source_page"), nodes, edges


def _ok(records: DataFrame) -> DataFrame:
    return records.where((F.col("status") == "ok") & F.col("raw_json").isNotNull()).select(F.col("record_id").cast("bigint"), F.lit(None).cast("int").alias("source_page"), "raw_json")


def unread_records(records: DataFrame) -> DataFrame:
    """(record_id, reason) of the page_records rows that give no page object: not ok, without text, or damaged."""
    status = F.coalesce("status", F.lit(""))
    left_out = records.where((status != "ok") | F.col("raw_json").isNull()).select(
        F.col("record_id").cast("bigint").alias("record_id"), F.when(status != "ok", F.concat(F.lit("status "), status)).otherwise(F.lit("no text")).alias("reason")
    )
    damaged = spread(_ok(records)).mapInPandas(_damaged_batches, "record_id bigint, reason string")
    return left_out.unionByName(damaged)


def _damaged_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        bad = [(r, "damaged") for r, raw in zip(batch["record_id"], batch["raw_json"], strict=True) if page_text(raw) is None]
        yield pd.DataFrame(bad, columns=["record_id", "reason"])


def profile_tables(profiles: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, nodes, edges) of the four lists of scientist_profiles, shredded as the pages are.

    records: record_id (the profile_id), source_page, root; a profile without lists has a root without edges.
    """
    raw = F.to_json(F.struct(*LISTS)).alias("raw_json")
    return _tables(profiles.select(F.col("profile_id").cast("bigint").alias("record_id"), F.col("source_page").cast("int").alias("source_page"), raw))


def _tables(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    shreds = cut_lineage(spread(rows).mapInPandas(_shred_batches, _SHREDS))
    return (
        shreds.where("root is not null").select("record_id", "source_page", "root"),
        shreds.where("node is not null").select("node", "content").dropDuplicates(["node"]),
        shreds.where("parent is not null").select("parent", "field", "ordinal", "child").distinct(),
    )


def _step(left: DataFrame, at: str, edges: DataFrame, spread_by: Column) -> DataFrame:
    """Follow edges from column at; the copies of a parent that very many rows share are spread over SALT parts."""
    return salted_join(left, edges.withColumnRenamed("parent", at), [at], spread_by, SALT).drop(at)


def list_items(records: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per non-null list item: record_id, scientist_pos, scientist, list_name, item_pos, item (identity)."""
    scientists = _step(records, "root", edges.where("field = 'scientists'").drop("field"), F.col("record_id")).select(
        "record_id", F.col("ordinal").alias("scientist_pos"), F.col("child").alias("scientist")
    )
    keep = cut_lineage(scientists.withColumn("parent", F.col("scientist")))
    return _step(keep, "parent", edges.where(F.col("field").isin(*LISTS)), F.struct("record_id", "scientist_pos")).select(
        "record_id",
        "scientist_pos",
        "scientist",
        F.col("field").alias("list_name"),
        F.col("ordinal").alias("item_pos"),
        F.col("child").alias("item"),
    )


def flat_list(records: DataFrame, nodes: DataFrame, edges: DataFrame, list_name: str, fields: dict[str, str], bare: str) -> DataFrame:
    """The flat table of one list: record_id, scientist_pos, item_pos and the fields, all as text.

    fields maps output columns to keys of the item's object; an item that is a bare string fills the column
    named by bare.
    """
    items = list_items(records, edges).where(F.col("list_name") == list_name)
    joined = items.join(nodes.withColumnRenamed("node", "item"), "item")
    return joined.select("record_id", "scientist_pos", "item_pos", *[_value(key, name == bare).alias(name) for name, key in fields.items()])


def _value(key: str, bare: bool) -> Column:
    """The text of a key of the item in content; if bare, that of an item that is no object."""
    is_object = F.col("content").startswith("{")
    value = F.when(is_object, F.get_json_object("content", f"$.{key}"))
    return F.coalesce(value, F.when(~is_object, F.get_json_object(F.concat(F.lit('{"v":'), F.col("content"), F.lit("}")), "$.v"))) if bare else value


def profile_items(records: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per non-null list item of a profile: profile_id, source_page, list_name, item_pos, content."""
    items = _step(records, "root", edges.where(F.col("field").isin(*LISTS)), F.col("record_id"))
    return items.join(nodes, F.col("child") == F.col("node")).select(
        F.col("record_id").alias("profile_id"), "source_page", F.col("field").alias("list_name"), F.col("ordinal").alias("item_pos"), "content"
    )


def flat_profile_list(records: DataFrame, nodes: DataFrame, edges: DataFrame, list_name: str, fields: dict[str, str], bare: str | None = None) -> DataFrame:
    """The flat table of one list of the profiles: profile_id, source_page, item_pos and the fields in their types.

    fields maps the keys of the item's object, which name the columns, to types; bare names the column that an
    item that is a bare string fills.
    """
    items = profile_items(records, nodes, edges.where(F.col("field") == list_name))
    return items.select("profile_id", "source_page", "item_pos", *[_value(key, key == bare).cast(t).alias(key) for key, t in fields.items()])


def profile_labels(records: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """All lists of the profiles in one table: profile_id, list_name, item_pos, label, place."""
    which = F.col("list_name")
    label = F.when(which == "education", _value("degree_type", False)).when(which == "societies", _value("name", True)).otherwise(_value("position_title", False))
    place = F.when(which == "education", _value("institution", False)).when(which != "societies", _value("institution_org", False))
    return profile_items(records, nodes, edges).select("profile_id", "list_name", "item_pos", label.alias("label"), place.alias("place"))
