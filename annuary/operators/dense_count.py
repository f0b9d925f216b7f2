"""Per-key counts whose work does not depend on how the rows are spread over the keys.

Each equal input split dictionary-encodes its own keys and adds them up in one dense accumulator array
(numpy.bincount). What leaves a split is one number for each distinct key in it, cut into array blocks by a
hash of the key; the blocks are summed by a distributed reduction. A key that holds a third of all rows
costs the reduction one number per split, like any other key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annuary.session import spread

#: Distinct keys that a split holds before it hands its array blocks on and starts anew; bounds memory only.
FLUSH_KEYS = 500_000
BLOCKS_PER_PARTITION = 4

_PARTIAL = pa.schema([("block", pa.int32()), ("keys", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


class _Accumulator:
    """A growing dictionary with a dense array of sums beside it."""

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}
        self.blocks: list[int] = []
        self.sums = np.zeros(1024, dtype=np.int64)

    def add(self, keys: list[str], amounts: np.ndarray, blocks: list[int] | None = None) -> None:
        codes = self.codes
        at = np.empty(len(keys), dtype=np.int64)
        for i, key in enumerate(keys):
            code = codes.get(key)
            if code is None:
                code = codes[key] = len(codes)
                if blocks is not None:
                    self.blocks.append(blocks[i])
            at[i] = code
        if len(codes) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros(max(len(self.sums), len(codes)), dtype=np.int64)])
        self.sums += np.bincount(at, weights=amounts, minlength=len(self.sums)).astype(np.int64) if len(keys) else 0


def _blocks_of(acc: _Accumulator) -> Iterator[pa.RecordBatch]:
    if not acc.codes:
        return
    keys = np.array(list(acc.codes), dtype=object)
    blocks = np.array(acc.blocks, dtype=np.int32)
    order = np.argsort(blocks, kind="stable")
    keys, blocks, sums = keys[order], blocks[order], acc.sums[: len(order)][order]
    cuts = np.flatnonzero(np.diff(blocks)) + 1
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(blocks[np.concatenate([[0], cuts])], pa.int32()),
            pa.array([list(x) for x in np.split(keys, cuts)], pa.list_(pa.string())),
            pa.array(np.split(sums, cuts), pa.list_(pa.int64())),
        ],
        schema=_PARTIAL,
    )


def _count_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    acc = _Accumulator()
    for batch in batches:
        encoded = batch.column("key").dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        counts = np.bincount(codes, minlength=len(encoded.dictionary))
        first = np.zeros(len(encoded.dictionary), dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        acc.add(encoded.dictionary.to_pylist(), counts, batch.column("block").to_numpy(zero_copy_only=False)[first].tolist())
        if len(acc.codes) > FLUSH_KEYS:
            yield from _blocks_of(acc)
            acc = _Accumulator()
    yield from _blocks_of(acc)


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    acc = _Accumulator()
    for batch in batches:
        keys, counts = batch.column("keys").flatten(), batch.column("counts").flatten()
        acc.add(keys.to_pylist(), counts.to_numpy(zero_copy_only=False))
    names = list(acc.codes)
    for at in range(0, len(names), 10_000):
        part = names[at : at + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array(acc.sums[at : at + len(part)], pa.int64())], names=["key", "n"]
        )


def dense_counts(df: DataFrame, keys: dict[str, Column], count_name: str = "n") -> DataFrame:
    """Rows of df per combination of keys (output column name -> expression), as those columns and a bigint count.

    Null keys form groups of their own, repeated rows count as often as they occur, an empty table gives no
    rows, other columns of df are ignored whatever their names.
    """
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[c.alias(name) for name, c in keys.items()])
    typed = spread(df.select(key.alias("k")))
    schema: T.StructType = typed.schema["k"].dataType
    coded = typed.select(F.to_json("k").alias("key")).withColumn(
        "block", F.pmod(F.xxhash64("key"), F.lit(n_parts * BLOCKS_PER_PARTITION)).cast("int")
    )
    partial = coded.mapInArrow(_count_split, "block int, keys array<string>, counts array<bigint>")
    summed = partial.repartition(n_parts, "block").mapInArrow(_sum_blocks, "key string, n bigint")
    return summed.select(F.from_json("key", schema).alias("k"), F.col("n").alias(count_name)).select("k.*", count_name)
