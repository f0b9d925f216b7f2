import numpy as np
import pytest
from pyspark.sql import functions as F

from annuary.llm import packing as P


def test_hilbert_visits_every_cell_by_single_steps():
    for d, bits in ((2, 3), (3, 2), (4, 2)):
        n = 1 << bits
        cells = np.array(np.meshgrid(*[np.arange(n)] * d, indexing="ij")).reshape(d, -1).T
        keys = P.hilbert(cells, bits)
        assert sorted(keys) == list(range(n**d))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packer_keeps_its_window_and_capacity():
    rng = np.random.default_rng(0)
    packer, room = P.Packer(100, 0, 8), {}
    for size in rng.integers(0, 101, 2000).tolist():
        container, _ = packer.put(size)
        room[container] = room.get(container, 100) - size
        assert room[container] >= 0 and len(packer.open) <= 8
    assert sum(100 - r for r in room.values()) / (100 * len(room)) > 0.85


@pytest.fixture(scope="module")
def packed(spark):
    rows = [(i, "the soluble prism of the committee " * (i % 40)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "word and word " * 3000), (1003, "same text " * 50), (1003, "same text " * 50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("place", F.lit("clash")).withColumn("n_tokens", F.lit("clash"))
    return rows, P.packed_documents(df, capacity=256).toPandas()


def test_every_token_is_packed_once(packed):
    rows, out = packed
    coder = P.encoding(P.VOCABULARY)
    assert out.groupby("container_id").n_tokens.sum().max() <= 256
    assert sorted(out[out.piece_no == 0].doc_id) == sorted(r[0] for r in rows)
    for doc, text in rows:
        n = len(coder.encode_ordinary(text or ""))
        part = out[out.doc_id == doc]
        assert part.n_tokens.sum() == n * (2 if doc == 1003 else 1)
        assert len(part) == (max(1, -(-n // 256)) if n > 256 else 1) * (2 if doc == 1003 else 1)
        assert (part.token_from == part.piece_no * 256).all()
    assert not out.duplicated(["container_id", "ordinal"]).any()


def test_little_room_is_left(packed):
    out = packed[1]
    used = out.groupby("container_id").n_tokens.sum()
    assert used.sum() / (256 * len(used)) > 0.85


def test_empty(spark):
    assert P.packed_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
