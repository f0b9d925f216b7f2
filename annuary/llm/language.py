"""Language of documents and of their single-language stretches, by segmentation-marginalised unigrams.

A fixed public piece vocabulary gives the units. Each language has a probability for every piece; the
probability of a word is the sum over all its segmentations into pieces, by a forward algorithm over the
word's lattice, and a sentence is the product of its words. Piece probabilities are fitted by expectation
maximisation on words of a bounded sample of labelled documents. A Viterbi pass over the sentences of a
document, with a cost per change of language, yields the stretches. Words of one text do not err independently,
so the confidence is calibrated on labelled documents that the fit has not seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.session import cut_lineage, spread

LANGUAGES = ("en", "de", "fr", "es", "it", "nl", "pt")
#: Spellings of language labels, lower case, without region.
LABELS = {
    "en": ["en", "eng", "english"],
    "de": ["de", "deu", "ger", "german", "deutsch"],
    "fr": ["fr", "fra", "fre", "french", "francais", "français"],
    "es": ["es", "spa", "spanish", "espanol", "español", "castilian", "castellano"],
    "it": ["it", "ita", "italian", "italiano"],
    "nl": ["nl", "nld", "dut", "dutch", "nederlands", "flemish"],
    "pt": ["pt", "por", "portuguese", "portugues", "português"],
}
#: Labels that say nothing.
NO_LABEL = ["", "und", "unknown", "none", "null", "n/a", "mul", "zxx"]

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Documents per label that the model is fitted on, in expectation: the bound of the sample.
SAMPLE_PER_LABEL = 400
EM_ROUNDS = 3
#: Documents per label outside the fit, in expectation, whose sentences calibrate the confidence: a bound like the first.
CALIBRATION_PER_LABEL = 60
#: Words from the start of a sentence that calibrate too, so that short texts are among those that teach.
SNIPPETS = (1, 2, 4, 8)
#: Natural-log cost of one change of language between sentences.
SWITCH_COST = 14.0
#: Longer runs of letters are cut, so that one lattice stays small; a cut costs a word boundary, no letter is lost.
MAX_WORD = 32
#: Words whose lattices are worked on together; bounds memory only.
WORDS_AT_ONCE = 4_000
#: Words whose scores a task keeps at hand; bounds memory only.
CACHE_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]{1,%d}" % MAX_WORD)
_HYPHEN = re.compile(r"-[ \t]*\n[ \t]*")
_CUT = re.compile(r"(?<=[.!?])[\"'»”)\]]*\s+|\n+|\s--\s")


def label_code(label: Column) -> Column:
    """The language a label names in any known spelling, '' for none or one that says nothing, else '?'."""
    bare = F.lower(F.regexp_replace(F.coalesce(label, F.lit("")), r"(?U)^\s+|\s+$", ""))
    short = F.when(bare.rlike("^[a-z]{2,3}[-_]"), F.regexp_extract(bare, "^([a-z]{2,3})[-_]", 1)).otherwise(bare)
    known = {name: code for code, names in LABELS.items() for name in names} | dict.fromkeys(NO_LABEL, "")
    codes = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, short), F.lit("?"))


def pieces(vocabulary: str) -> list[str]:
    """The lower-case pieces of a sentencepiece model, word starts marked by U+2581."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    out = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return sorted({p for p in out if p == p.lower() and re.fullmatch(r"▁?[^\W\d_]+", p)})


@dataclass
class Lattice:
    """Edges of all words, sorted by where they end; alpha of state (word, position) is their sum."""

    words: int
    width: int
    start: np.ndarray
    stop: np.ndarray
    piece: np.ndarray
    final: np.ndarray


def beginnings(index: dict[str, int]) -> dict[str, int]:
    """Every beginning of a piece with the number of the piece that it is, -1 if it is none."""
    out = dict.fromkeys((p[:n] for p in index for n in range(1, len(p))), -1)
    out.update(index)
    return out


def build_lattice(words: list[str], starts: dict[str, int], unknown: int) -> Lattice:
    """Every way to cut '▁word' into pieces (starts: their beginnings). A character no piece covers becomes the unknown piece."""
    width = MAX_WORD + 2
    edges: list[int] = []  # where an edge stops in its word, the state it starts from and its piece, as one number
    get, add = starts.get, edges.append
    for w, word in enumerate(words):
        text = "▁" + word
        n, base = len(text), w * width
        for i in range(n):
            here = (base + i) << 20
            p = get(text[i])
            if p is None or p < 0:
                add((i + 1 << 44) + here + unknown)
            else:
                add((i + 1 << 44) + here + p)
            if p is not None:
                for j in range(i + 2, n + 1):
                    p = get(text[i:j])
                    if p is None:
                        break  # no piece goes on like this
                    if p >= 0:
                        add((j << 44) + here + p)
    code = np.sort(np.asarray(edges, dtype=np.int64))
    start = code >> 20 & (1 << 24) - 1
    final = np.arange(len(words)) * width + np.array([len(x) + 1 for x in words], dtype=np.int64)
    return Lattice(len(words), width, start, start // width * width + (code >> 44), code & (1 << 20) - 1, final)


def forward(lattice: Lattice, probability: np.ndarray) -> np.ndarray:
    """alpha[state, language] of all states."""
    alpha = np.zeros((lattice.words * lattice.width, probability.shape[1]))
    alpha[np.arange(lattice.words) * lattice.width] = 1.0
    position = lattice.stop % lattice.width
    cuts = np.searchsorted(position, np.arange(lattice.width + 1))
    for k in range(1, lattice.width):
        a, b = cuts[k], cuts[k + 1]
        if a == b:
            continue
        np.add.at(alpha, lattice.stop[a:b], alpha[lattice.start[a:b]] * probability[lattice.piece[a:b]])
    return alpha


def backward(lattice: Lattice, probability: np.ndarray) -> np.ndarray:
    beta = np.zeros((lattice.words * lattice.width, probability.shape[1]))
    beta[lattice.final] = 1.0
    position = lattice.stop % lattice.width
    cuts = np.searchsorted(position, np.arange(lattice.width + 1))
    for k in range(lattice.width - 1, 0, -1):
        a, b = cuts[k], cuts[k + 1]
        if a < b:
            np.add.at(beta, lattice.start[a:b], beta[lattice.stop[a:b]] * probability[lattice.piece[a:b]])
    return beta


@dataclass
class Model:
    starts: dict[str, int]
    probability: np.ndarray

    def score(self, words: list[str]) -> np.ndarray:
        """log P(word | language), one row per word."""
        if not words:
            return np.zeros((0, self.probability.shape[1]), dtype=np.float32)
        lattice = build_lattice(words, self.starts, len(self.probability) - 1)
        return np.log(np.maximum(forward(lattice, self.probability)[lattice.final], 1e-290)).astype(np.float32)


def fit(counts: dict[str, dict[str, int]], vocabulary: list[str], rounds: int = EM_ROUNDS) -> Model:
    """Piece probabilities per language by expectation maximisation over word counts (language -> word -> count).

    A language without words gets the average of the others. Pieces that a language never uses keep the
    weight of a fraction of one occurrence.
    """
    words = sorted({w for c in counts.values() for w in c})
    starts = beginnings({p: i for i, p in enumerate(vocabulary)})
    weight = np.zeros((len(words), len(LANGUAGES)))
    at = {w: i for i, w in enumerate(words)}
    for k, language in enumerate(LANGUAGES):
        for w, n in counts.get(language, {}).items():
            weight[at[w], k] = n
    absent = weight.sum(axis=0) == 0
    if absent.any() and not absent.all():
        weight[:, absent] = weight[:, ~absent].mean(axis=1, keepdims=True)
    size = np.array([max(len(p), 1) for p in vocabulary] + [1], dtype=float)
    p = np.repeat((0.02 ** (1 / size))[:, None], len(LANGUAGES), axis=1)
    p[-1] = 1e-6
    p /= p.sum(axis=0)
    blocks = [range(i, min(i + WORDS_AT_ONCE, len(words))) for i in range(0, len(words), WORDS_AT_ONCE)]
    lattices = [build_lattice([words[i] for i in b], starts, len(vocabulary)) for b in blocks]
    for _ in range(rounds if words else 0):
        n = np.full_like(p, 0.05)
        for block, lattice in zip(blocks, lattices, strict=True):
            word_of = lattice.start // lattice.width
            alpha, beta = forward(lattice, p), backward(lattice, p)
            per_word = weight[block.start : block.stop] / np.maximum(alpha[lattice.final], 1e-290)
            np.add.at(n, lattice.piece, alpha[lattice.start] * p[lattice.piece] * beta[lattice.stop] * per_word[word_of])
        n[-1] = 0.05
        p = n / n.sum(axis=0)
    return Model(starts, p)


@dataclass
class Confidence:
    """How far the scores of so many words are to be believed: they are divided by exp(a) * words ** b.

    Without labelled documents outside the fit, by the square root of the words.
    """

    a: float = 0.0
    b: float = 0.5

    def of(self, scores: np.ndarray, words: np.ndarray | int) -> np.ndarray:
        """The probability of each language; scores has one row per text."""
        s = (scores - scores.max(axis=-1, keepdims=True)) / (np.exp(self.a) * np.power(np.asarray(words, dtype=float), self.b))[..., None]
        e = np.exp(s)
        return e / e.sum(axis=-1, keepdims=True)


def calibrate(scores: np.ndarray, words: np.ndarray, label: np.ndarray, least: int = 50) -> Confidence:
    """The confidence under which the labels are likeliest, when some share of them is wrong at random."""
    if len(label) < least:
        return Confidence()

    def loss(a: float, b: float) -> float:
        p = Confidence(a, b).of(scores, words)[np.arange(len(label)), label]
        return min(-np.log((1 - wrong) * p + wrong / (len(LANGUAGES) - 1) * (1 - p)).mean() for wrong in (0.005, 0.01, 0.02, 0.04, 0.08, 0.16))

    def best(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
        return min((loss(x, y), x, y) for x in a.tolist() for y in b.tolist())[1:]

    # A wide grid first, then a narrow one around its best point.
    a, b = best(np.arange(-2, 4.01, 0.6), np.arange(0, 1.01, 0.2))
    return Confidence(*best(a + np.arange(-0.4, 0.41, 0.2), np.clip(b + np.array([-0.1, 0.0, 0.1]), 0, 1)))


def labelled_share(documents: DataFrame, skip: int, take: int, inside: int = 0) -> DataFrame:
    """(doc_id, text, label, inside): of each label's documents about take, drawn after about skip others; a hash draws.

    The column inside tells which of them are among the first inside ones.
    """
    labelled = documents.select("doc_id", "text", label_code(F.col("lang")).alias("label")).where(F.col("label").isin(*LANGUAGES))
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    at = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    place = F.lit(None)
    for label, n in sizes.items():
        place = F.when(F.col("label") == label, at * n).otherwise(place)
    drawn = labelled.withColumn("place", place).where((F.col("place") >= skip) & (F.col("place") < skip + take) & F.col("text").isNotNull())
    return drawn.select("doc_id", "text", "label", (F.col("place") < inside).alias("inside"))


def calibration(labelled: DataFrame, shared) -> Confidence:
    """The confidence for a broadcast model, from sentences of labelled documents outside its fit, and their first words.

    labelled (text, label) is a bounded sample. Documents whose text as a whole is of another language than their
    label are left out as wrongly labelled.
    """

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(shared.value)
        for batch in batches:
            rows = []
            for label, text in zip(batch["label"], batch["text"], strict=True):
                found = tagger.sentence_scores(text)
                if found and LANGUAGES[sum(s.sum(axis=0) for s in found).argmax()] == label:
                    rows += [(label, n, s[:n].sum(axis=0).tolist()) for s in found for n in {*SNIPPETS, len(s)} if n <= len(s)]
            yield pd.DataFrame(rows, columns=["label", "words", "scores"])

    found = labelled.select("label", "text").mapInPandas(score, "label string, words int, scores array<double>").collect()
    if not found:
        return Confidence()
    at = {language: i for i, language in enumerate(LANGUAGES)}
    return calibrate(np.array([r["scores"] for r in found]), np.array([r["words"] for r in found]), np.array([at[r["label"]] for r in found]))


def word_counts(labelled: DataFrame) -> dict[str, dict[str, int]]:
    """How often each word occurs under each label in a bounded sample (text, label)."""
    words = labelled.select(
        "label", F.explode(F.regexp_extract_all(F.lower(F.regexp_replace("text", r"-[ \t]*\n[ \t]*", "")), F.lit(r"(\p{L}{1,%d})" % MAX_WORD))).alias("word")
    )
    out: dict[str, dict[str, int]] = {}
    for r in words.groupBy("label", "word").count().collect():
        out.setdefault(r["label"], {})[r["word"]] = r["count"]
    return out


def training_counts(documents: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> dict[str, dict[str, int]]:
    """Word counts by label over a bounded sample: of each label's documents a share of per_label / all of them."""
    return word_counts(labelled_share(documents, 0, per_label))


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, stop) of the sentences; hyphens at line ends must have been taken out."""
    out, at = [], 0
    for m in _CUT.finditer(text):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def viterbi(scores: np.ndarray, cost: float) -> np.ndarray:
    """The best language of each row of scores under a cost per change."""
    n, k = scores.shape
    best = scores[0].astype(float)
    back = np.zeros((n, k), dtype=np.int64)
    for i in range(1, n):
        top = int(best.argmax())
        stay = best >= best[top] - cost
        back[i] = np.where(stay, np.arange(k), top)
        best = np.where(stay, best, best[top] - cost) + scores[i]
    path = np.empty(n, dtype=np.int64)
    path[-1] = best.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


class Tagger:
    """Scores sentences with a cache of word scores, and finds the stretches of a document."""

    def __init__(self, model: Model, cost: float = SWITCH_COST, confidence: Confidence | None = None) -> None:
        self.model, self.cost, self.confidence = model, cost, confidence or Confidence()
        self.at: dict[str, int] = {}
        self.table = np.zeros((0, len(LANGUAGES)), dtype=np.float32)

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.at]
        if not new:
            return
        if len(self.at) + len(new) > CACHE_WORDS:
            self.at.clear()
            self.table = self.table[:0]
            new = sorted(words)
        parts = [self.table]
        for i in range(0, len(new), WORDS_AT_ONCE):
            parts.append(self.model.score(new[i : i + WORDS_AT_ONCE]))
        for w in new:
            self.at[w] = len(self.at)
        self.table = np.concatenate(parts)

    def sentence_scores(self, text: str) -> list[np.ndarray]:
        """For each sentence of a text that has words, their scores, one row per word."""
        joined = _HYPHEN.sub("", text).lower()
        found = [w for w in (_WORD.findall(joined, a, b) for a, b in sentences(joined)) if w]
        self._learn({w for s in found for w in s})
        return [self.table[[self.at[w] for w in s]].astype(np.float64) for s in found]

    def batch(self, texts: list[str]) -> list[list[tuple[int, int, str, float, int, int]]]:
        """For each text its stretches: (number, sentences, language, confidence, start, stop of the characters)."""
        joined = [_HYPHEN.sub("", t) for t in texts]
        cuts, words, sizes, owner = [], [], [], []
        for d, text in enumerate(joined):
            low = text.lower()
            if len(low) != len(text):
                low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
            for a, b in sentences(text):
                found = _WORD.findall(low, a, b)
                if not found:
                    continue
                cuts.append((a, b))
                words.append(found)
                sizes.append(len(found))
                owner.append(d)
        out: list[list[tuple[int, int, str, float, int, int]]] = [[] for _ in texts]
        if not words:
            return out
        flat = [w for s in words for w in s]
        self._learn(set(flat))
        at = self.at
        ids = np.fromiter((at[w] for w in flat), dtype=np.int64, count=len(flat))
        sizes = np.array(sizes)
        rows = np.add.reduceat(self.table[ids], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0, dtype=np.float64)
        owner = np.array(owner)
        firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        totals = np.add.reduceat(rows, firsts, axis=0)
        best = totals.argmax(axis=1)
        lasts = np.append(firsts[1:], len(owner))
        regret = np.add.reduceat(rows.max(axis=1) - rows[np.arange(len(owner)), np.repeat(best, lasts - firsts)], firsts)
        for k, (a, b) in enumerate(zip(firsts.tolist(), lasts.tolist(), strict=True)):
            # Where no sentence gains enough by another language, no change can pay for itself.
            path = np.full(b - a, best[k]) if regret[k] < self.cost else viterbi(rows[a:b], self.cost)
            change = np.flatnonzero(np.diff(path)) + 1
            for number, (i, j) in enumerate(zip([0, *change.tolist()], [*change.tolist(), b - a], strict=True), start=1):
                p = self.confidence.of(rows[a + i : a + j].sum(axis=0), int(sizes[a + i : a + j].sum()))
                out[owner[a]].append((number, j - i, LANGUAGES[path[i]], float(p[path[i]]), cuts[a + i][0], cuts[a + j - 1][1]))
        return out


_STRETCH = "doc_id bigint, label string, stretch_no int, n_stretches int, n_sentences int, lang string, confidence double, char_from int, char_to int"


def stretches(documents: DataFrame, vocabulary: str = VOCABULARY, per_label: int = SAMPLE_PER_LABEL, cost: float = SWITCH_COST) -> DataFrame:
    """One row per longest single-language stretch of every document, numbered from 1 in reading order.

    label is the code that the delivered label names ('' none, '?' not one of the known languages). Characters
    are counted after hyphens at line ends are taken out. A null, empty or letterless text gives one row with
    language 'und', confidence 0 and no sentences. An empty table, or one without any usable label, gives the
    uniform model and still one or more rows per document. confidence is the calibrated probability of the
    stretch's language.
    """
    spark = documents.sparkSession
    sample = cut_lineage(labelled_share(documents, 0, per_label + CALIBRATION_PER_LABEL, per_label))
    shared = spark.sparkContext.broadcast(fit(word_counts(sample.where("inside")), pieces(vocabulary)))
    trust = calibration(sample.where("not inside"), shared)

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(shared.value, cost, trust)
        names = [x.split()[0] for x in _STRETCH.split(", ")]
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            rows = []
            ids, labels = batch["doc_id"].tolist(), batch["label"].tolist()
            for at in range(0, len(texts), 500):
                for doc, label, found in zip(ids[at : at + 500], labels[at : at + 500], tagger.batch(texts[at : at + 500]), strict=True):
                    for number, n, language, confidence, a, b in found:
                        rows.append((doc, label, number, len(found), n, language, confidence, a, b))
                    if not found:
                        rows.append((doc, label, 1, 1, 0, "und", 0.0, 0, 0))
            yield pd.DataFrame(rows, columns=names)

    chosen = spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), label_code(F.col("lang")).alias("label"), "text"))
    return chosen.mapInPandas(tag, _STRETCH)


def relabelled(documents: DataFrame, **options) -> DataFrame:
    """The stretches of documents whose label is missing or wrong or whose text has more than one language."""
    s = stretches(documents, **options)
    wrong = (F.col("label") == "") | (F.col("n_stretches") > 1) | (F.col("label") != F.col("lang"))
    return s.where(wrong & (F.col("lang") != "und"))
