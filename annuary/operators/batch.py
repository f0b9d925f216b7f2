"""Results of a batch of page requests: decoding, routing, cost; and the packing of requests into files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.session import cut_lineage, numbered

#: Price per million fresh, cached and produced tokens of three models; a batch costs half.
RATES = {"large": (5.00, 0.50, 30.00), "medium": (2.50, 0.25, 15.00), "small": (0.50, 0.05, 3.00)}
BATCH_SHARE = 0.5
#: Most bytes and requests of one file.
MAX_BYTES, MAX_REQUESTS = 180 * 1024 * 1024, 50_000

ENVELOPE = """custom_id string, focus_page_number string, error string, usage struct<input_tokens:bigint, output_tokens:bigint, cached_input_tokens:bigint, reasoning_tokens:bigint>,
response struct<status_code:int, body:struct<output:array<struct<type:string, content:array<struct<type:string, text:string, refusal:string>>>>,
usage:struct<input_tokens:bigint, output_tokens:bigint, input_tokens_details:struct<cached_tokens:bigint>, output_tokens_details:struct<reasoning_tokens:bigint>>,
incomplete_details:struct<reason:string>, error:string>>"""


def request_id(page: Column) -> Column:
    return F.format_string("page-%05d", page)


def request_lines(pages: DataFrame, model: str, effort: str) -> DataFrame:
    """(page, line): the JSON request of every page, with the page after it as look-ahead.

    The page after is the next number; whether it exists is known from the pages themselves.
    """
    own = pages.select("page").distinct()
    following = own.select((F.col("page") - 1).alias("page"), F.col("page").alias("look_ahead"))
    body = F.struct(F.lit(model).alias("model"), F.lit(effort).alias("effort"), F.array_compact(F.array("page", "look_ahead")).alias("pages"))
    rows = own.join(following, "page", "left")
    return rows.select("page", F.to_json(F.struct(request_id(F.col("page")).alias("custom_id"), F.lit("POST").alias("method"), body.alias("body"))).alias("line"))


def page_of_request(custom_id: Column) -> Column:
    return F.substring_index(custom_id, "-", -1).try_cast("int")


def json_part(text: Column) -> Column:
    """From the first opening to the last closing brace, code fences thus dropped; null if there is none."""
    first, last = F.instr(text, "{"), F.length(text) - F.instr(F.reverse(text), "}") + 1
    return F.when((first > 0) & (F.instr(text, "}") > 0) & (last >= first), text.substr(first, last - first + 1))


def _pieces(line: Column) -> Column:
    """All pieces of the messages of a decoded batch line."""
    return F.flatten(F.transform(F.coalesce(line["response"]["body"]["output"], F.array()), lambda o: F.coalesce(o["content"], F.array())))


def _joined_text(pieces: Column) -> Column:
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["type"] == "output_text"), lambda p: F.coalesce(p["text"], F.lit(""))), "")


def output_text(raw: Column) -> Column:
    """The message text of a batch result line."""
    return _joined_text(_pieces(F.from_json(raw, ENVELOPE)))


def decode(lines: DataFrame) -> DataFrame:
    """Batch result lines (record_id, raw_json) with page, outcome, text, refusal and token usage.

    Outcomes in order of precedence: corrupt (the line is no JSON), error, truncated, empty, unparseable, ok.
    """
    whole = F.try_parse_json("raw_json").isNotNull()
    rows = lines.select("record_id", F.when(whole, F.from_json("raw_json", ENVELOPE)).alias("r"), whole.alias("whole"))
    rows = rows.withColumn("pieces", _pieces(F.col("r"))).withColumn("text", _joined_text(F.col("pieces")))
    refusal = F.get(F.filter("pieces", lambda p: p["type"] == "refusal"), 0)["refusal"]
    failed = F.col("r.error").isNotNull() | ~F.coalesce(F.col("r.response.status_code") == 200, F.lit(False))
    outcome = (
        F.when(~F.col("whole"), "corrupt")
        .when(failed, "error")
        .when(F.col("r.response.body.incomplete_details.reason") == "max_output_tokens", "truncated")
        .when(F.trim("text") == "", "empty")
        .when(F.try_parse_json(json_part(F.col("text"))).isNull(), "unparseable")
        .otherwise("ok")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    used = "r.response.body.usage"
    return rows.select(
        "record_id",
        F.coalesce(page_of_request(F.col("r.custom_id")), F.col("r.focus_page_number").try_cast("int")).alias("page"),
        outcome.alias("outcome"),
        "text",
        refusal.alias("refusal"),
        zero(f"{used}.input_tokens").alias("input_tokens"),
        zero(f"{used}.output_tokens").alias("output_tokens"),
        zero(f"{used}.input_tokens_details.cached_tokens").alias("cached_tokens"),
        zero(f"{used}.output_tokens_details.reasoning_tokens").alias("reasoning_tokens"),
    )


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where("outcome <> 'ok'").select("record_id", "page", "outcome", "refusal")


def cost(model: Column, fresh_and_cached: Column, cached: Column, produced: Column, batch: Column) -> Column:
    """Dollars of one call; 0 for a model without a price."""
    total = F.lit(0.0)
    for name, (a, b, c) in RATES.items():
        total = F.when(model == name, ((fresh_and_cached - cached) * a + cached * b + produced * c) / 1e6).otherwise(total)
    return total * F.when(batch, BATCH_SHARE).otherwise(1.0)


def cost_rollup(calls: DataFrame, extrapolate_to: int) -> DataFrame:
    """Tokens and dollars by model (columns model, input_tokens, cached_tokens, output_tokens, batch), per call and for so many calls."""
    priced = calls.withColumn("usd", cost(F.col("model"), F.col("input_tokens"), F.col("cached_tokens"), F.col("output_tokens"), F.col("batch")))
    return priced.groupBy("model").agg(
        F.count("*").alias("n_calls"),
        F.sum("input_tokens").cast("bigint").alias("input_tokens"),
        F.sum("output_tokens").cast("bigint").alias("output_tokens"),
        F.round(F.sum("usd"), 4).alias("usd"),
        F.round(F.avg("usd"), 4).alias("usd_per_call"),
        F.round(F.avg("usd") * extrapolate_to, 2).alias("usd_all"),
    )


#: Requests whose sizes travel as one block to the task that folds them.
BLOCK = 50_000


def _files_of(sizes: np.ndarray, state: tuple[int, int, int], max_bytes: int, max_requests: int) -> tuple[np.ndarray, tuple[int, int, int]]:
    """The file of each request from the state (file, its bytes, its requests) before them, and the state after.

    Whole files are found in the running sum, one search for each.
    """
    number, held, count = state
    out = np.empty(len(sizes), dtype=np.int64)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        room = int(np.searchsorted(sums, sums[at] + max_bytes - held, side="right")) - 1 if number else at
        stop = min(room, at + max_requests - count, len(sizes))
        if stop <= at:
            # Nothing more fits; a request that is larger than a file has one to itself.
            number, held, count = number + 1, int(sizes[at]), 1
            out[at] = number
            at += 1
            continue
        out[at:stop] = number
        held, count, at = held + int(sums[stop] - sums[at]), count + stop - at, stop
    return out, (number, held, count)


def pack_requests(requests: DataFrame, max_bytes: int = MAX_BYTES, max_requests: int = MAX_REQUESTS) -> DataFrame:
    """Requests (request_no, bytes) with the number of their file from 1: a new file when bytes or count would pass the limit.

    Each file starts where the one before it ended, so one task must see all sizes in order. The requests are
    sorted and gathered into blocks by all tasks; the one task reads a block of sizes at a time and hands back the
    state before each block, from which the blocks are numbered by all tasks again.
    """
    placed = numbered(requests.select("request_no", "bytes"), [F.asc("request_no")]).withColumn("block", F.floor((F.col("ordinal") - 1) / BLOCK))
    rows = F.sort_array(F.collect_list(F.struct("ordinal", "request_no", "bytes")))  # BLOCK of them
    blocks = cut_lineage(placed.groupBy("block").agg(rows.alias("r")).select("block", F.col("r.request_no").alias("request_no"), F.col("r.bytes").alias("bytes")))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = (0, 0, 0)
        for b in batches:
            out = []
            for block, sizes in zip(b["block"].tolist(), b["bytes"], strict=True):
                out.append((block, *state))
                state = _files_of(np.asarray(sizes), state, max_bytes, max_requests)[1]
            yield pd.DataFrame(out, columns=["block", "number", "held", "count"])

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                yield pd.DataFrame({"request_no": r.request_no, "file_no": _files_of(np.asarray(r.bytes), (r.number, r.held, r.count), max_bytes, max_requests)[0]})

    before = blocks.select("block", "bytes").repartition(1).sortWithinPartitions("block").mapInPandas(walk, "block bigint, number bigint, held bigint, count bigint")
    return blocks.join(before, "block").mapInPandas(fill, "request_no bigint, file_no bigint")


def progress(decoded: DataFrame) -> DataFrame:
    """One line that tells how many calls are done, of how many, and how many failed."""
    ok = F.sum((F.col("outcome") == "ok").cast("int"))
    return decoded.agg(F.format_string("%d/%d done, %d failed", ok, F.count("*"), F.count("*") - ok).alias("progress"))
