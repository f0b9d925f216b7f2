"""Filling containers of fixed capacity along a space-filling curve.

Each document becomes a vector by feature hashing of its tokens, projected to a few dimensions; the cell it
falls in has a place on a Hilbert curve. Documents are range-sorted by that place and packed in this order,
so that neighbours in a container are alike. Within a window of open containers the best fit is taken.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuary.session import cut_lineage, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CAPACITY = 2048
DIMENSIONS = 4
BITS = 8
#: Containers that stay open at once; an item may only join one of these, which keeps neighbours together.
OPEN = 48


@lru_cache(maxsize=2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("documents", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def directions(n: int, dimensions: int) -> np.ndarray:
    """A fixed random direction for every token number."""
    return np.random.default_rng(20_240_601).standard_normal((n, dimensions)).astype(np.float32)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer cells (rows) with the given bits per dimension, by Gray-code rotation."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def measured(documents: DataFrame, vocabulary: str = VOCABULARY, dimensions: int = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """(doc_id, n_tokens, place): token count and Hilbert place of every document; null text counts as empty."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoding(vocabulary)
        axes = directions(coder.n_vocab, dimensions)
        for batch in batches:
            sizes = np.zeros(len(batch), dtype=np.int64)
            vectors = np.zeros((len(batch), dimensions))
            for i, text in enumerate(batch["text"]):
                if not isinstance(text, str) or not text:
                    continue
                ids = np.asarray(coder.encode_ordinary(text), dtype=np.int64)
                sizes[i] = len(ids)
                # Scaled by its length, the vector of a random text is standard normal in each dimension.
                vectors[i] = axes[ids].sum(axis=0) / max(1.0, np.sqrt(len(ids)))
            cells = ((np.tanh(vectors / 3) + 1) / 2 * ((1 << bits) - 1)).round().astype(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": sizes, "place": hilbert(cells, bits)})

    return spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).mapInPandas(measure, "doc_id bigint, n_tokens bigint, place bigint")


class Packer:
    """Best fit among a bounded number of open containers."""

    def __init__(self, capacity: int, first_id: int, window: int = OPEN) -> None:
        self.capacity, self.next_id, self.window = capacity, first_id, window
        self.open: list[tuple[int, int]] = []  # (room, container), least room first
        self.count: dict[int, int] = {}

    def put(self, size: int) -> tuple[int, int]:
        """(container, ordinal in it) for an item of at most the capacity."""
        at = bisect.bisect_left(self.open, (size, -1))
        if at < len(self.open):
            room, container = self.open.pop(at)
        else:
            room, container = self.capacity, self.next_id
            self.next_id += 1
        room -= size
        ordinal = self.count.get(container, 0)
        self.count[container] = ordinal + 1
        if room > 0 and size < self.capacity:
            bisect.insort(self.open, (room, container))
            if len(self.open) > self.window:
                self.count.pop(self.open.pop(0)[1])
        else:
            self.count.pop(container)
        return container, ordinal


_PACKED = "container_id bigint, ordinal int, doc_id bigint, piece_no int, token_from bigint, n_tokens bigint"


def pack(sizes: DataFrame, capacity: int = CAPACITY, window: int = OPEN) -> DataFrame:
    """Containers for documents given as (doc_id, n_tokens, place), one row per document or piece of one.

    A document of at most capacity tokens stays whole. A longer one is cut at multiples of the capacity: its
    full pieces fill containers of their own, its rest is packed like any document. Documents without tokens
    are packed too and need no room. Equal places, even those of very many equal texts, are told apart by
    doc_id, so no range of the sort is larger than the others. An empty table gives no containers.
    """
    n_parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full = F.when(F.col("n_tokens") > capacity, F.floor(F.col("n_tokens") / capacity)).otherwise(F.lit(0))
    rest = F.when(F.col("n_tokens") > capacity, F.col("n_tokens") % capacity).otherwise(F.col("n_tokens"))
    last = F.when((F.col("n_tokens") > capacity) & (rest == 0), full - 1).otherwise(full)
    pieces = sizes.select("doc_id", "n_tokens", "place", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("piece_no")).select(
        "place",
        "doc_id",
        "piece_no",
        (F.col("piece_no").cast("bigint") * capacity).alias("token_from"),
        F.when(F.col("n_tokens") > capacity, F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - F.col("piece_no") * capacity))
        .otherwise(F.col("n_tokens"))
        .cast("bigint")
        .alias("n_tokens"),
    )
    ordered = pieces.repartitionByRange(n_parts, "place", "doc_id", "piece_no").sortWithinPartitions("place", "doc_id", "piece_no")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(capacity, TaskContext.get().partitionId() << 40, window)
        for batch in batches:
            placed = [packer.put(int(n)) for n in batch["n_tokens"]]
            yield pd.DataFrame(
                {
                    "container_id": np.array([p[0] for p in placed], dtype=np.int64),
                    "ordinal": np.array([p[1] for p in placed], dtype=np.int32),
                    "doc_id": batch["doc_id"],
                    "piece_no": batch["piece_no"],
                    "token_from": batch["token_from"],
                    "n_tokens": batch["n_tokens"],
                }
            )

    return ordered.mapInPandas(fill, _PACKED)


def packed_documents(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, window: int = OPEN) -> DataFrame:
    """Containers for whole documents; see pack. Token counts and places are written once, then range-sorted."""
    return pack(cut_lineage(measured(documents, vocabulary)), capacity, window)
