import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from annuary.llm import language as L

TEXT = {
    "en": "The curator measured the density of the membrane and the committee repeated every specimen. Nothing explains why the fern should be so rapid.",
    "de": "Der Ausschuss hat die Vererbung der Farn gemessen und die Tafeln nicht wiederholt. Frau Weber hat die seltene Probe beschrieben.",
    "fr": "Le docteur a mesuré la répartition du lichen et la couleur restait obscure. Pourquoi madame n'a-t-elle pas décrit le métal?",
    "es": "El profesor ha recogido la distribución del hongo en la ciudad. ¿Por qué no ha contado el alumno el liquen?",
    "it": "La commissione ha misurato la crescita del quarzo e la struttura rimase oscura. Perché il dottore non ha riscaldato il fermento?",
    "nl": "De leerling heeft de kleine gletsjer bij de stad niet vergeleken. Het is niet bekend waarom de dokter het schrift heeft verloren.",
    "pt": "A comissão tem discutido um trabalho sobre o cristal em abril. O professor tinha contado não só o nervo, mas também o fungo.",
}


def brute(word, index, p, longest):
    """Sum over all segmentations, one by one."""
    text = "▁" + word

    def rest(i):
        if i == len(text):
            return 1.0
        total, covered = 0.0, False
        for j in range(i + 1, min(len(text), i + longest) + 1):
            k = index.get(text[i:j])
            if k is not None:
                covered = covered or j == i + 1
                total += p[k] * rest(j)
        return total if covered else total + p[-1] * rest(i + 1)

    return rest(0)


def test_forward_sums_all_segmentations():
    vocabulary = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba"]
    model = L.fit({"en": {"ab": 3, "aba": 1}, "de": {"ba": 2}}, vocabulary)
    words = ["ab", "aba", "bab", "xyz", "a"]
    scores = model.score(words)
    for w, row in zip(words, scores, strict=True):
        for k in range(len(L.LANGUAGES)):
            assert row[k] == pytest.approx(math.log(brute(w, {q: i for q, i in model.starts.items() if i >= 0}, model.probability[:, k], max(map(len, model.starts)))), rel=1e-4)
    assert np.allclose(model.probability.sum(axis=0), 1)


def test_viterbi_equals_best_path():
    rng = np.random.default_rng(1)
    for _ in range(20):
        s = rng.normal(size=(5, 3)) * 10
        best, want = -1e9, None
        for code in range(3**5):
            path = [code // 3**i % 3 for i in range(5)]
            value = sum(s[i, k] for i, k in enumerate(path)) - 4 * sum(a != b for a, b in zip(path, path[1:]))
            if value > best:
                best, want = value, path
        assert L.viterbi(s, 4).tolist() == want


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i * 10 + k, (t + " ") * (1 + k % 2), lang, "x") for i, (lang, t) in enumerate(TEXT.items()) for k in range(8)]
    rows += [
        (1000, TEXT["de"], None, "x"),
        (1001, TEXT["fr"], " und ", "x"),
        (1002, TEXT["es"], "en", "x"),
        (1003, TEXT["it"], "Italian", "x"),
        (1004, TEXT["en"], "en-US", "x"),
        (1005, TEXT["en"] + " -- " + TEXT["nl"], "en", "x"),
        (1006, TEXT["pt"].replace(" ", "-\n", 0).replace("comissão", "comis-\nsão") + "\n" + TEXT["de"] + "\n" + TEXT["pt"], "pt", "x"),
        (1007, None, "en", "x"),
        (1008, "", None, "x"),
        (1009, "12 -- 34 . . .", "de", "x"),
        (1010, "a" * 100_000 + " " + TEXT["en"] * 300, "en", "x"),
        (1011, TEXT["en"], "sv", "x"),
        (1002, TEXT["es"], "en", "x"),
        (None, TEXT["en"], "en", "x"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, label string").withColumn("stretch_no", F.lit("clash")).withColumn("draw", F.lit(1))


def test_stretches(documents):
    rows = L.stretches(documents).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["stretch_no"], r["lang"]))
    assert sorted(by[1005]) == [(1, "en"), (2, "nl")]
    assert sorted(by[1006]) == [(1, "pt"), (2, "de"), (3, "pt")]
    assert by[1010] == [(1, "en")] and by[1007] == by[1008] == by[1009] == [(1, "und")]
    assert len(by[1002]) == 2
    for i, lang in enumerate(TEXT):
        assert all(x == [(1, lang)] for d, x in by.items() if d is not None and d < 1000 and d // 10 == i)
    assert all(0 <= r["confidence"] <= 1 for r in rows)


def test_only_missing_wrong_or_mixed_are_relabelled(documents):
    got = sorted({(r["doc_id"], r["stretch_no"], r["lang"]) for r in L.relabelled(documents).collect()})
    assert got == [(1000, 1, "de"), (1001, 1, "fr"), (1002, 1, "es"), (1005, 1, "en"), (1005, 2, "nl"), (1006, 1, "pt"), (1006, 2, "de"), (1006, 3, "pt"), (1011, 1, "en")]


def test_empty_and_unlabelled(documents):
    assert L.stretches(documents.where("doc_id < 0")).count() == 0
    assert L.stretches(documents.where("doc_id = 1000")).count() == 1


def test_held_out_accuracy(spark, data):
    """Documents that the fit has not seen: the share tagged as labelled. A few labels are wrong by design."""
    larger = data.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{larger if os.path.isdir(larger) else data}/documents.parquet")
    seen, unseen = L.labelled_share(docs, 0, 60), L.labelled_share(docs, 60, 1_000_000)
    assert seen.count() and unseen.count() > 200 and not seen.join(unseen, "doc_id").take(1)
    tagger = L.Tagger(L.fit(L.training_counts(docs, 60), L.pieces(L.VOCABULARY)))
    rows = unseen.toPandas()
    right = [max(found, key=lambda s: s[1])[2] == label for found, label in zip(tagger.batch(rows["text"].tolist()), rows["label"], strict=True) if found]
    assert sum(right) / len(right) > 0.93


def test_confidence_is_as_often_right_as_it_says():
    rng = np.random.default_rng(8)
    words = rng.integers(1, 30, 20_000)
    scores = rng.normal(0, 3, (20_000, 7))
    true = L.Confidence(0.4, 0.3).of(scores, words)
    label = np.array([rng.choice(7, p=p) for p in true])
    found = L.calibrate(scores, words, label)
    p = found.of(scores, words)
    top, right = p.max(axis=1), p.argmax(axis=1) == label
    for low, high in ((0.2, 0.4), (0.4, 0.6), (0.6, 0.8), (0.8, 1.01)):
        some = (top >= low) & (top < high)
        assert abs(top[some].mean() - right[some].mean()) < 0.05
    assert L.calibrate(scores[:3], words[:3], label[:3]) == L.Confidence()


def test_unsure_where_there_is_little_text(documents):
    sure = {r["doc_id"]: r["confidence"] for r in L.stretches(documents).collect()}
    assert sure[1007] == sure[1008] == 0 and sure[0] > 0.9
    tagger = L.Tagger(L.fit(L.training_counts(documents), L.pieces(L.VOCABULARY)))
    short, long = tagger.batch(["a", TEXT["en"]])
    assert short[0][3] < long[0][3]
