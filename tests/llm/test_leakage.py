import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annuary.llm import leakage as K

WORDS = [a + b + c for a in ("bra", "clo", "dri", "fen", "gla") for b in ("mon", "tel", "ver", "sin") for c in ("by", "ton", "ford", "well", "dale")]


def words(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def damage(rng, text, errors):
    out = list(text)
    for at in sorted(rng.sample(range(1, len(out) - 1), errors), reverse=True):
        kind = rng.choice("mla")
        if kind == "m":
            out[at] = out[at][1] + out[at][0] + out[at][2:] + "x"
        elif kind == "l":
            del out[at]
        else:
            out.insert(at, "zz")
    return out


def test_three_damages_shared_by_all_windows():
    plain = WORDS[:24]
    index = K.index_items([(1, " ".join(plain))])
    doc = [w + "x" if at in (8, 11, 14) else w for at, w in enumerate(plain)]
    # The rarest n-grams are just those that the damages spoil.
    counts = np.full(len(index.grams), 100)
    counts[index.gram_of[0][6:15]] = 1
    found = K.Finder(index, K.choose_seeds(index, counts)).document(" ".join(["zz", *doc, "yy"]))
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in found] == [(1, 21, 3, 0, 23)]


def test_seeds_never_miss_a_damaged_window():
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, 60))) for i in range(30)]
    index = K.index_items(items)
    counts = np.array([rng.randrange(1000) for _ in index.grams])
    finder = K.Finder(index, K.choose_seeds(index, counts))
    for i, text in items:
        plain = text.split()
        for _ in range(10):
            at = rng.randrange(0, 44)
            doc = words(rng, 30) + damage(rng, plain[at : at + 16], 2) + words(rng, 30)
            found = {r[0] for r in finder.document(" ".join(doc))}
            kept = plain[at : at + 16]
            # Damage at the ends may leave fewer than 16 words of the item; then nothing is promised.
            best = K.best_passage(K.smith_waterman(*_numbers(kept, doc)), kept, doc)
            assert best is None or i in found


def scattered(rng, length):
    """Places of as many damages as a passage of this length may have: anywhere, in a row, or three words apart."""
    n = length // 8
    step = rng.choice((0, 1, 3))
    if not step:
        return sorted(rng.sample(range(1, length - 1), n))
    first = rng.randrange(1, max(2, length - 1 - step * n))
    return sorted({min(length - 2, first + step * k) for k in range(n)})


def hurt(rng, text, places):
    out = list(text)
    for at in reversed(places):
        kind = rng.choice("mla")
        if kind == "m":
            out[at] = out[at][1] + out[at][0] + out[at][2:]
        elif kind == "l":
            del out[at]
        else:
            out.insert(at, "zz")
    return out


def test_no_passage_is_lost_wherever_its_damages_stand():
    rng = random.Random(11)
    for _ in range(12):
        items = [(i, " ".join(words(rng, 60))) for i in range(20)]
        index = K.index_items(items)
        counts = np.array([rng.choice([1, 1000, rng.randrange(1000)]) for _ in index.grams])
        finder = K.Finder(index, K.choose_seeds(index, counts))
        for i, text in items * 5:
            length = rng.randrange(16, 49)
            at = rng.randrange(0, 61 - length)
            doc = words(rng, 30) + hurt(rng, text.split()[at : at + length], scattered(rng, length)) + words(rng, 30)
            assert i in {r[0] for r in finder.document(" ".join(doc))}


def test_too_many_damages_are_no_passage():
    rng = random.Random(12)
    for _ in range(100):
        item = [f"{w}{k}" for k, w in enumerate(words(rng, 16))]
        doc = [w if k not in (2, 8, 13) else "qqqqq" for k, w in enumerate(item)]
        assert K.exact_passage(item, doc) is None and K.best_passage(K.smith_waterman(*_numbers(item, doc)), item, doc) is None


def _numbers(a, b):
    at = {w: k for k, w in enumerate(dict.fromkeys([*a, *b]))}
    return np.array([at[w] for w in a]), np.array([at[w] for w in b])


def test_smith_waterman_score_equals_plain_recursion():
    rng = random.Random(5)
    for _ in range(30):
        a, b = [rng.randrange(4) for _ in range(9)], [rng.randrange(4) for _ in range(12)]
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        top = 0
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (K.MATCH if a[i - 1] == b[j - 1] else -K.COST), h[i - 1][j] - K.COST, h[i][j - 1] - K.COST)
                top = max(top, h[i][j])
        path = K.smith_waterman(np.array(a), np.array(b))
        assert sum(K.MATCH if op == 0 else -K.COST for op, *_ in path) == top


@pytest.mark.parametrize("a,b,expected", [("tadpole", "tadople", True), ("basalt", "basallt", True), ("basalt", "quartz", False), ("of", "or", True), ("", "ab", False)])
def test_misprint(a, b, expected):
    assert K.misprint(a, b) is expected


def test_leaks(spark):
    rng = random.Random(7)
    item = words(rng, 50)
    other = words(rng, 40)
    text = " ".join(item)
    wrapped = text[:100] + "-\n" + text[100:200].upper() + ",  " + text[200:]
    docs = [
        (1, " ".join(words(rng, 40)) + " " + text),
        (2, "Intro. " + " ".join(item[10:26]) + "; end"),
        (3, " ".join(item[10:25])),
        (4, wrapped),
        (5, " ".join(damage(rng, item[5:37], 3))),
        (6, " ".join(words(rng, 3000)) + " " + " ".join(other[:20]) + " " + " ".join(words(rng, 20_000))),
        (7, None),
        (8, ""),
        (9, " ".join(item[::-1])),
        (1, " ".join(words(rng, 40)) + " " + text),
        (10, " ".join(w if k % 5 else "x" + w[::-1] for k, w in enumerate(item))),
    ]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit("clash")).withColumn("gram", F.lit(0))
    items = spark.createDataFrame([(100, text), (200, " ".join(other)), (300, "too short"), (400, None), (100, text)], "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = sorted((r["doc_id"], r["item_id"]) for r in K.leaks(documents, items).collect())
    once = [(1, 100), (1, 100), (2, 100), (4, 100), (5, 100)]
    assert got == sorted(once * 2 + [(6, 200)])
    blocks = sorted((r["doc_id"], r["item_id"]) for r in K.leaks(documents, items.dropDuplicates(["item_id"]), letters_per_pass=450).collect())
    assert blocks == sorted(once + [(6, 200)])
    assert K.leaks(documents.where("doc_id < 0"), items).count() == 0
    assert K.leaks(documents, items.where("item_id < 0")).count() == 0
