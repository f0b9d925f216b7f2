"""Evaluation texts inside corpus documents: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are compared after lower-casing, with apostrophes and hyphens at line ends taken out; everything that
is not a letter or digit separates words. A passage counts when at least WINDOW successive words of an item
stand in the document with at most one word in ERROR_RATE misprinted, lost or added. Another word in the place
of one is a word lost and a word added, unless it is close enough in spelling to be a misprint of it.

Seeds. In a window of WINDOW item words at most WINDOW / ERROR_RATE are damaged, and a damage spoils at most
SEED word n-grams. So of the n-grams of a window it is enough to look for as many as can be spoilt and one
more; the rarest in the corpus are taken, from counts over all documents. A passage of half a window more may
have one damage more in the words that all its windows share, so windows of that length are filled up to as
many seeds as they need; of any longer passage some window has no more than its share of damages. Every
passage therefore keeps a seed, while common turns of phrase are hardly ever looked up.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuary.session import spread

WINDOW = 16
ERROR_RATE = 8
SEED = 3
#: What a matching word earns in an alignment, and what another, a lost or an added one costs.
MATCH, COST = 5, 2
#: Every passage that counts holds a stretch of one of these lengths with one damage in ERROR_RATE at most.
SPANS = (WINDOW, WINDOW + ERROR_RATE)
#: Letters of items that are looked for in one pass over the corpus; a larger set of items is taken in several
#: passes. The seeds of a pass are broadcast, about thirty times as large, so this bounds the broadcast.
LETTERS_PER_PASS = 2_000_000

_HYPHEN = re.compile(r"-[ \t]*\r?\n[ \t]*")
_MARK = re.compile(r"['’`]")
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(_MARK.sub("", _HYPHEN.sub("", text)).lower())


@dataclass
class Items:
    """Item texts as word numbers, with their n-grams."""

    ids: list[int]
    vocabulary: dict[str, int]
    words: list[np.ndarray]
    grams: np.ndarray  # sorted distinct n-gram codes
    gram_of: list[np.ndarray]  # for each item, the number of the n-gram at each position


def codes(words: np.ndarray, base: int) -> np.ndarray:
    """The code of the n-gram at each position, -1 where a word is not in the vocabulary."""
    n = len(words) - SEED + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    out = np.zeros(n, dtype=np.int64)
    bad = np.zeros(n, dtype=bool)
    for k in range(SEED):
        part = words[k : k + n]
        out = out * base + part
        bad |= part < 0
    out[bad] = -1
    return out


def index_items(rows: list[tuple[int, str]]) -> Items:
    vocabulary: dict[str, int] = {}
    ids, words = [], []
    for item, text in rows:
        numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text or "")]
        if len(numbers) >= WINDOW:
            ids.append(item)
            words.append(np.array(numbers, dtype=np.int64))
    base = len(vocabulary) + 1
    if base**SEED >= 2**62:
        raise ValueError("too many different words in one pass; lower LETTERS_PER_PASS")
    coded = [codes(w, base) for w in words]
    grams = np.unique(np.concatenate(coded)) if coded else np.empty(0, dtype=np.int64)
    return Items(ids, vocabulary, words, grams, [np.searchsorted(grams, c) for c in coded])


def choose_seeds(items: Items, counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each n-gram number its (item, position) pairs, kept where it is among the rarest of some window.

    A longer window takes the seeds of the shorter ones inside it and its rarest others, up to what it needs.
    """
    where: list[list[tuple[int, int]]] = [[] for _ in range(len(items.grams))]
    for i, gram in enumerate(items.gram_of):
        chosen = np.zeros(len(gram), dtype=bool)
        seen = counts[gram]
        for span in SPANS:
            per_window = span - SEED + 1
            need = min(per_window, (span // ERROR_RATE) * SEED + 1)
            for a in range(len(gram) - per_window + 1):
                order = np.argsort(seen[a : a + per_window], kind="stable")
                if span > WINDOW:
                    inside = chosen[a : a + per_window]
                    order = order[~inside[order]][: max(0, need - int(inside.sum()))]
                chosen[a + order[:need]] = True
        for p in np.flatnonzero(chosen):
            where[gram[p]].append((i, int(p)))
    return where


def look_up(words: np.ndarray, base: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, n-gram numbers) of the item n-grams in a document."""
    coded = codes(words, base)
    at = np.flatnonzero(coded >= 0)
    if not len(at) or not len(grams):
        return at[:0], at[:0]
    found = np.searchsorted(grams, coded[at])
    found[found == len(grams)] = 0
    hit = grams[found] == coded[at]
    return at[hit], found[hit]


def smith_waterman(item: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int]]:
    """The best local alignment (match MATCH, mismatch and gap -COST) as (operation, item position, text position).

    Operations: 0 match, 1 substitution, 2 item word lost, 3 word added in the text. Two damages cost less than
    one match earns, so that a passage is not cut off where two stand right after its first word.
    """
    m, n = len(item), len(text)
    score = np.zeros((m + 1, n + 1), dtype=np.int32)
    ramp = np.arange(n + 1, dtype=np.int32) * COST
    for i in range(1, m + 1):
        row = np.zeros(n + 1, dtype=np.int32)
        row[1:] = np.maximum(score[i - 1, :-1] + np.where(text == item[i - 1], MATCH, -COST), score[i - 1, 1:] - COST)
        np.maximum(row, 0, out=row)
        score[i] = np.maximum.accumulate(row + ramp) - ramp
    i, j = np.unravel_index(int(score.argmax()), score.shape)
    out = []
    while i > 0 and j > 0 and score[i, j] > 0:
        same = item[i - 1] == text[j - 1]
        if score[i, j] == score[i - 1, j - 1] + (MATCH if same else -COST):
            i, j = i - 1, j - 1
            out.append((0 if same else 1, int(i), int(j)))
        elif score[i, j] == score[i - 1, j] - COST:
            i -= 1
            out.append((2, int(i), int(j)))
        else:
            j -= 1
            out.append((3, int(i), int(j)))
    return out[::-1]


@functools.lru_cache(maxsize=200_000)
def misprint(a: str, b: str) -> bool:
    """Whether b may be a misprint of a: edit distance (with swapped neighbours) of a third of the length at most."""
    limit = max(1, max(len(a), len(b)) // 3)
    if abs(len(a) - len(b)) > limit:
        return False
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        row = [i]
        for j, y in enumerate(b, start=1):
            cost = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1] <= limit


def damages(item: list[str], text: list[str]) -> int:
    """The fewest damages that turn these words of an item into these of a text: misprints, lost and added words."""
    last = list(range(len(text) + 1))
    for i, x in enumerate(item, start=1):
        row = [i]
        for j, y in enumerate(text, start=1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (1 if misprint(x, y) else 2)))
        last = row
    return last[-1]


def best_passage(path: list[tuple[int, int, int]], item: list[str], text: list[str]) -> tuple[int, int, int, int, int, int] | None:
    """The longest part of an alignment that counts: (matched, errors, item from, item to, text from, text to).

    Between two matching words the damages are counted anew, since an alignment does not know which of two words
    is the misprint.
    """
    same = [(i, j) for op, i, j in path if op == 0]
    if not same:
        return None
    errors = [0]
    for (i, j), (k, m) in zip(same, same[1:], strict=False):
        lost, added = k - i - 1, m - j - 1
        most = max(lost, added)
        # So many cannot be in any passage that counts.
        few = lost and added and most * ERROR_RATE <= len(item)
        errors.append(errors[-1] + (damages(item[i + 1 : k], text[j + 1 : m]) if few else most if lost and added else lost + added))
    wrong, at = np.array(errors), np.array([i for i, _ in same])
    best = None
    for a in range(len(same)):
        span, bad = at[a:] - at[a] + 1, wrong[a:] - wrong[a]
        good = np.flatnonzero((span >= WINDOW) & (bad * ERROR_RATE <= span))
        if len(good):
            k = good[-1]
            if best is None or span[k] > best[0]:
                best = (int(span[k]), int(bad[k]), a, a + int(k))
    if best is None:
        return None
    (i, j), (k, m) = same[best[2]], same[best[3]]
    return best[3] - best[2] + 1, best[1], i, k, j, m


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of words, and which letters they have, as bits by their codes modulo 64."""
    return np.array([len(w) for w in words]), np.array([functools.reduce(operator.or_, (1 << (ord(c) & 63) for c in w), 0) for w in words], dtype=np.uint64)


def costs(item: list[str], text: list[str]) -> np.ndarray:
    """Damages for each word of an item in the place of each word of a text: 0 equal, 1 a misprint, 2 another word."""
    # A misprint changes few letters, which rules out nearly all pairs at once.
    (n, own), (m, other) = letters_of(item), letters_of(text)
    limit = np.maximum(1, np.maximum(n[:, None], m) // 3)
    apart = np.maximum(np.bitwise_count(own[:, None] & ~other), np.bitwise_count(other & ~own[:, None]))
    cost = np.full((len(item), len(text)), 2, dtype=np.int32)
    for i, j in zip(*np.nonzero((np.abs(n[:, None] - m) <= limit) & (apart <= limit)), strict=True):
        x, y = item[i], text[j]
        if x == y:
            cost[i, j] = 0
        elif misprint(x, y):
            cost[i, j] = 1
    return cost


def exact_passage(item: list[str], text: list[str]) -> tuple[int, int, int, int, int, int] | None:
    """A passage that counts, the longest from the first word of the item where one begins, or None; as best_passage.

    Every stretch of the item is aligned with the whole text by itself, so nothing is lost to the choice of one
    alignment. A passage begins and ends with a matching word.
    """
    cost = costs(item, text)
    at = np.arange(len(text) + 1)
    # A word that is nowhere in the text is a damage at least.
    damaged = np.concatenate([[0], np.cumsum(cost.min(axis=1) > 0)])
    for a in range(len(item) - WINDOW + 1):
        longest = len(item) - a
        spans = np.arange(WINDOW, longest + 1)
        if damaged[a + 1] > damaged[a] or not ((damaged[a + WINDOW :] - damaged[a]) * ERROR_RATE <= spans).any():
            continue
        row, start, found = np.where(np.append(1, cost[a]) == 0, 0, longest), at - 1, None  # the first word matches
        for i in range(1, longest):
            whole, lost = row[:-1] + cost[a + i], row[1:] + 1
            best = np.concatenate([[longest], np.minimum(whole, lost)]) - at
            begin = np.concatenate([[0], np.where(whole <= lost, start[:-1], start[1:])])
            ends = np.where(cost[a + i] == 0, row[:-1], longest)
            least = np.minimum.accumulate(best)  # words added in the text
            if i + 1 >= WINDOW and ends.min() * ERROR_RATE <= i + 1:
                j = int(ends.argmin())
                found = i + 1 - int(ends[j]), int(ends[j]), a, a + i, int(start[j]), j
            row, start = least + at, begin[np.maximum.accumulate(np.where(best == least, at, 0))]
            if row.min() * ERROR_RATE > longest:
                break
        if found:
            return found
    return None


class Finder:
    """Finds the passages of a block of items in documents."""

    def __init__(self, items: Items, seeds: list[list[tuple[int, int]]]) -> None:
        self.items = items
        self.base = len(items.vocabulary) + 1
        self.names = list(items.vocabulary)
        kept = [g for g, where in enumerate(seeds) if where]
        self.grams = items.grams[kept]
        self.where = [seeds[g] for g in kept]

    def document(self, text: str) -> list[tuple]:
        """(item id, matched, errors, item from, item to, word from, word to) for each item that leaked."""
        get = self.items.vocabulary.get
        plain = words_of(text)
        words = np.array([get(w, -1) for w in plain], dtype=np.int64)
        at, found = look_up(words, self.base, self.grams)
        if not len(at):
            return []
        by_item: dict[int, list[int]] = {}
        for j, g in zip(at.tolist(), found.tolist(), strict=True):
            for i, p in self.where[g]:
                by_item.setdefault(i, []).append(j - p)
        out = []
        for i, diagonals in by_item.items():
            item = self.items.words[i]
            slack = len(item) // ERROR_RATE + 2
            diagonals = sorted(set(diagonals))
            best = None
            group = [diagonals[0]]
            for x in [*diagonals[1:], None]:
                if x is not None and x - group[-1] <= slack:
                    group.append(x)
                    continue
                low, high = max(0, group[0] - slack), min(len(words), group[-1] + len(item) + slack)
                passage = self.verify(i, words[low:high], plain[low:high])
                if passage and (best is None or passage[0] > best[0]):
                    best = (*passage[:4], passage[4] + low, passage[5] + low)
                group = [x]
            if best:
                out.append((self.items.ids[i], *best))
        return out

    def verify(self, i: int, text: np.ndarray, plain: list[str]) -> tuple | None:
        item = self.items.words[i]
        # A stretch of the item that counts has nearly all its words, and all n-grams but those that its damages
        # spoil, somewhere in this stretch of text.
        words, grams = np.isin(item, text), np.isin(codes(item, self.base), codes(text, self.base))
        for n in SPANS:
            few = n // ERROR_RATE
            if len(item) >= n and (_windows(words, n) >= n - few).any() and (_windows(grams, n - SEED + 1) >= n - SEED + 1 - few * SEED).any():
                break
        else:
            return None
        names = [self.names[w] for w in item]
        return best_passage(smith_waterman(item, text), names, plain) or exact_passage(names, plain)


def _windows(flags: np.ndarray, n: int) -> np.ndarray:
    """How many flags are set in every window of n."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[n:] - sums[:-n]


def item_blocks(items: DataFrame, letters_per_pass: int = LETTERS_PER_PASS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of a bounded number of letters (one item at least), read one block at a time."""
    rows: list[tuple[int, str]] = []
    size = 0
    for r in items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null").toLocalIterator():
        n = len(r["text"])
        if rows and size + n > letters_per_pass:
            yield rows
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += n
    if rows:
        yield rows


def corpus_counts(documents: DataFrame, items: Items) -> np.ndarray:
    """How often each item n-gram occurs in all documents. What is collected has the size of the item block."""
    shared = documents.sparkSession.sparkContext.broadcast((items.vocabulary, items.grams))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, grams = shared.value
        get, base = vocabulary.get, len(vocabulary) + 1
        sums = np.zeros(len(grams), dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                if isinstance(text, str):
                    _, found = look_up(np.array([get(w, -1) for w in words_of(text)], dtype=np.int64), base, grams)
                    if len(found):
                        sums += np.bincount(found, minlength=len(grams))
        some = np.flatnonzero(sums)
        yield pd.DataFrame({"gram": some, "n": sums[some]})

    out = np.zeros(len(items.grams), dtype=np.int64)
    for r in spread(documents.select("text")).mapInPandas(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r["gram"]] = r["n"]
    return out


_LEAK = "doc_id bigint, item_id bigint, matched int, errors int, item_from int, item_to int, word_from int, word_to int"


def leaks(documents: DataFrame, items: DataFrame, letters_per_pass: int = LETTERS_PER_PASS) -> DataFrame:
    """One row per document and item whose text it holds, wholly or partly, with the longest passage found.

    matched and errors count words; positions count words from 0 and include the last. Null or empty texts,
    and items shorter than WINDOW words, give nothing. Repeated items and documents each give rows of their
    own. The items are taken in blocks, each against all documents.
    """
    spark = documents.sparkSession
    out = spark.createDataFrame([], _LEAK)
    chosen = spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    for block in item_blocks(items, letters_per_pass):
        indexed = index_items(block)
        if not indexed.ids:
            continue
        shared = spark.sparkContext.broadcast(Finder(indexed, choose_seeds(indexed, corpus_counts(documents, indexed))))

        def find(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            finder = shared.value
            names = [x.split()[0] for x in _LEAK.split(", ")]
            for batch in batches:
                rows = [(d, *r) for d, t in zip(batch["doc_id"], batch["text"], strict=True) if isinstance(t, str) for r in finder.document(t)]
                yield pd.DataFrame(rows, columns=names)

        out = out.unionByName(chosen.mapInPandas(find, _LEAK))
    return out
