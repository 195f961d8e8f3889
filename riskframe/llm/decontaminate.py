"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are few beside the corpus but may grow, so they are taken in blocks of bounded size, each
sent to all tasks; a block is a stated query set against all rows. Per block the corpus is read
twice: to count the two-word runs of its items over all documents, and to search.

An alignment that reaches the threshold by words replaced or lost holds at least :func:`least_runs`
two-word runs of the item. The runs most frequent in the corpus are no seeds as long as they stand
for at most half of that number, so at least the other half must be hit close together: whatever
the counts are, and however often an item was copied, such a copy has its seeds. Only copies with
foreign words pushed in between nearly all words of the item can have too few. Around the hits, the
words are aligned with the whole item, unless the words that both share cannot reach the threshold
in any order. The score is the local alignment score over that of the item with itself, so edited,
shortened or reordered copies score in proportion. Nothing but findings leaves a task.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import free_name
from riskframe.session import materialise

_WORDS = re.compile(r"[^\W_]+")
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bound of one block of items, in words.
BLOCK_WORDS = 1_000_000
#: Items of fewer words are found by three-word runs: two words identify nothing.
LONG = 9
#: Characters of texts that are looked through together.
JOINED_CHARS = 200_000
#: Words of windows that wait for their alignment, of one aligned batch with padding, of one window.
HELD_WORDS, BATCH_WORDS, WINDOW_WORDS = 2_000_000, 1_000_000, 16_384


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def least_runs(size: int, threshold: float) -> int:
    """Two-word runs of an item of ``size`` words in any alignment of that score.

    m words in r unbroken runs score at most 2 m - (r - 1), and r - 1 words of the item at least are
    replaced or lost between the runs, so m + r - 1 <= size; m - r is least where both are equal.
    """
    reach = MATCH * threshold * size
    return max(1, math.ceil((2 * reach - size - 3) / 3 - 1e-9))


def _padded(windows: list[np.ndarray]) -> np.ndarray:
    table = np.full((len(windows), max(map(len, windows))), -1, np.int64)
    for i, w in enumerate(windows):
        table[i, : len(w)] = w
    return table


def most_scores(windows: list[np.ndarray], item: np.ndarray) -> np.ndarray:
    """A bound that no alignment of each window with the item exceeds.

    An alignment spans a stretch of the item, in which a word that the window lacks costs one.
    """
    table = _padded(windows)
    total, low, most = (np.zeros(len(windows), np.int64) for _ in range(3))
    for word in item:
        total = total + np.where((table == word).any(1), MATCH, max(MISMATCH, GAP))
        low = np.minimum(low, total)
        most = np.maximum(most, total - low)
    return most


def local_scores(windows: list[np.ndarray], item: np.ndarray) -> list[tuple[int, int]]:
    """(best Smith-Waterman score, position after its last word) of each window against the item.

    All windows at once; the gap inside a row follows from a running maximum.
    """
    table = _padded(windows)
    width = table.shape[1]
    fall = GAP * np.arange(width + 1)
    row = np.zeros((len(windows), width + 1), np.int64)
    best, end = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + np.where(table == word, MATCH, MISMATCH))
        row = np.maximum(np.maximum.accumulate(new - fall, axis=1) + fall, new)
        top = row.max(1)
        better = top > best
        best = np.where(better, top, best)
        end = np.where(better, row.argmax(1), end)
    return list(zip(best.tolist(), end.tolist()))


class Items:
    """A block of test items as word numbers, with an index of their n-grams: pairs, in short items triples.

    Words that no item has are number 0. An n-gram is held as one number below 2**63 as long as
    the vocabulary of a block allows, else as a mixing number.
    """

    def __init__(self, ids: list, texts: list, threshold: float):
        self.ids, self.vocabulary, self.words = ids, {}, []
        number = self.vocabulary
        for text in texts:
            self.words.append(np.array([number.setdefault(w, len(number) + 1) for w in words_of(text)], np.int64))
        self.base = np.int64(len(number) + 1)
        self.size = np.array([len(w) for w in self.words], np.int64)
        least = [least_runs(len(w), threshold) if len(w) >= LONG else 1 for w in self.words]
        self.spare = np.array(least, np.int64) // 2  # positions that may go without a seed
        self.needed = np.array(least, np.int64) - self.spare
        self.parts = {n: self._index(n) for n in (2, 3)}

    @classmethod
    def of(cls, state: dict) -> Items:
        items = cls.__new__(cls)
        items.__dict__.update(state)
        return items

    def _index(self, n: int) -> dict:
        """Distinct (gram, item) in order, with the first and last position and their number."""
        rows = []
        for i, words in enumerate(self.words):
            if (len(words) >= LONG) == (n == 2):
                gram, first, times = np.unique(self.grams(words, n), return_index=True, return_counts=True)
                last = len(words) - min(n, len(words)) - np.unique(self.grams(words, n)[::-1], return_index=True)[1]
                rows.append((gram, np.full(len(gram), i), first, last, times))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 5
        return self._sorted(dict(zip(("gram", "item", "first", "last", "times"), columns)))

    @staticmethod
    def _sorted(index: dict) -> dict:
        order = np.argsort(index["gram"], kind="stable")
        index = {c: v[order] for c, v in index.items() if c != "distinct"}
        index["distinct"] = np.unique(index["gram"])
        return index

    def keep_rare(self, counts: np.ndarray) -> None:
        """Leave out the most frequent pairs of each long item; ``counts`` go with the distinct pairs."""
        index = self.parts[2]
        often = counts[np.searchsorted(index["distinct"], index["gram"])]
        order = np.lexsort((index["gram"], -often, index["item"]))
        item, times = index["item"][order], index["times"][order]
        so_far = np.cumsum(times)
        begin = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, int)
        before = np.repeat((so_far - times)[begin], np.diff(np.r_[begin, len(item)]))
        kept = np.sort(order[so_far - before > self.spare[item]])
        self.parts[2] = self._sorted({c: v[kept] for c, v in index.items() if c != "distinct"})

    def joined(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word numbers of all texts, each followed by a 0; where each begins; its number of words)."""
        get, words, sizes = self.vocabulary.get, [], []
        for text in texts:
            before = len(words)
            words += [get(w, 0) for w in words_of(text)]
            sizes.append(len(words) - before)
            words.append(0)
        size = np.array(sizes, np.int64)
        return np.array(words, np.int64), np.cumsum(size + 1) - size - 1, size

    def grams(self, words: np.ndarray, n: int) -> np.ndarray:
        """One number per position; -1 where a word is foreign to all items.

        A text shorter than ``n`` words has one n-gram, itself; no number means both.
        """
        n = min(n, len(words))
        if n == 0:
            return np.zeros(0, np.int64)
        parts = [words[i : len(words) - n + 1 + i] for i in range(n)]
        foreign = np.logical_or.reduce([p == 0 for p in parts])
        fits = int(self.base) ** 3 < 1 << 63
        out = np.zeros(len(parts[0]), np.int64)
        for p in parts:  # exact below 2**63, else a mixing number whose rare clashes only add candidates
            out = out * self.base + p if fits else (out * np.int64(0x5851F42D4C957F2D) + p) & np.int64((1 << 62) - 1)
        out[foreign] = -1
        return out

    def hits(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, number of the distinct gram) of each n-gram of joined texts that an item holds."""
        distinct = self.parts[n]["distinct"]
        if not len(distinct) or not len(words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams = np.full(len(words), -1, np.int64)
        whole = self.grams(words, n)  # a gram that spans two texts holds a 0
        grams[: len(whole)] = whole
        for i in np.flatnonzero((sizes > 0) & (sizes < n)):
            grams[starts[i]] = self.grams(words[starts[i] : starts[i] + sizes[i]], n)[0]
        hit = np.flatnonzero(grams >= 0)
        at = np.minimum(np.searchsorted(distinct, grams[hit]), len(distinct) - 1)
        found = distinct[at] == grams[hit]
        return hit[found], at[found]


def _chunks(columns: list[list]):
    """Rows of equally long columns (the last holds texts) in runs of about ``JOINED_CHARS``."""
    begin = chars = 0
    for i, text in enumerate(columns[-1]):
        chars += len(text or "")
        if chars >= JOINED_CHARS:
            yield [c[begin : i + 1] for c in columns]
            begin, chars = i + 1, 0
    if begin < len(columns[-1]):
        yield [c[begin:] for c in columns]


def _spots(items: Items, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """(text, item, first, last) windows, in words of that text, around enough seeds of the item."""
    out = []
    for n, index in items.parts.items():
        hit, at = items.hits(words, starts, sizes, n)
        if not len(hit):
            continue
        gram = index["distinct"][at]
        lo, hi = np.searchsorted(index["gram"], gram, "left"), np.searchsorted(index["gram"], gram, "right")
        k = hi - lo
        row = np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(k.sum())
        item, place = index["item"][row], np.repeat(hit, k)
        text = np.searchsorted(starts, place, "right") - 1
        order = np.lexsort((place, item))
        text, item, place, row = text[order], item[order], place[order], row[order]
        size = items.size[item]
        new = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (place[1:] - place[:-1] > size[1:])
        first = np.flatnonzero(np.r_[True, new])
        enough = np.diff(np.r_[first, len(item)]) >= items.needed[item[first]]
        slack = size // 2 + 4  # how far inserted or lost words may move the copy
        start = np.minimum.reduceat(place - index["last"][row] - slack, first)[enough]
        stop = np.maximum.reduceat(place - index["first"][row] + size + slack, first)[enough]
        for t, i, a, b in zip(text[first][enough].tolist(), item[first][enough].tolist(), start.tolist(), stop.tolist()):
            a, b, own = max(0, a - int(starts[t])), min(int(sizes[t]), b - int(starts[t])), len(items.words[i])
            step = max(WINDOW_WORDS, 8 * own)  # an alignment spans at most twice the item
            out.extend((t, i, x, min(b, x + step + 2 * own)) for x in range(a, b, step))
    return out


def _counted(items: Items, batches):
    """How often the texts hold each distinct pair of the items, one row per pair that occurs."""
    counts = np.zeros(len(items.parts[2]["distinct"]), np.int64)
    for b in batches:
        for (texts,) in _chunks([b[0].to_pylist()]):
            np.add.at(counts, items.hits(*items.joined(texts), 2)[1], 1)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"at": pa.array(seen, pa.int64()), "n": pa.array(counts[seen], pa.int64())})


def _findings(items: Items, threshold: float, batches):
    schema = pa.schema(
        [("doc", pa.int64()), ("item", pa.int64()), ("score", pa.float64()), ("from_word", pa.int64()), ("to_word", pa.int64())]
    )

    def scored(item: int, held: list):
        full = MATCH * len(items.words[item])
        rows = []
        reach = most_scores([h[2] for h in held], items.words[item])
        held = [h for h, most in zip(held, reach) if most >= threshold * full]
        for (doc, first, _), (best, end) in zip(held, local_scores([h[2] for h in held], items.words[item]) if held else []):
            if full and best >= threshold * full:
                rows.append({"doc": doc, "item": items.ids[item], "score": best / full, "from_word": max(0, first + end - len(items.words[item])), "to_word": first + end})
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    held: dict[int, list] = {}
    widest: dict[int, int] = {}
    total = 0
    for b in batches:
        for docs, texts in _chunks([b[0].to_pylist(), b[1].to_pylist()]):
            words, starts, sizes = items.joined(texts)
            for text, item, first, last in _spots(items, words, starts, sizes):
                width = max(widest.get(item, 0), last - first)
                if item in held and width * (len(held[item]) + 1) > BATCH_WORDS:
                    total -= sum(len(h[2]) for h in held[item])
                    yield scored(item, held.pop(item))
                    width = last - first
                held.setdefault(item, []).append((docs[text], first, words[starts[text] + first : starts[text] + last].copy()))
                widest[item], total = width, total + last - first
                if total > HELD_WORDS:
                    for waiting in list(held):
                        yield scored(waiting, held.pop(waiting))
                    widest, total = {}, 0
    for item in list(held):
        yield scored(item, held.pop(item))


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int):
    """The items in blocks of at most ``limit`` words (an item above that is a block of its own)."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(item, text).where(F.col(item).isNotNull()).toLocalIterator():
        n = len(words_of(row[1]))
        if n == 0:
            continue
        if ids and size + n > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        size += n
    if ids:
        yield ids, texts


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and test item found in it: key, item, score, from_word, to_word.

    ``score`` is the best alignment as a share of a full match (1: the whole item, word by word);
    ``from_word`` and ``to_word`` bound its last words in the document. Defined results: missing or
    empty texts and items hold nothing, an item of one or two words is found only in documents just as
    short (they identify nothing in a longer one), one of fewer than ``LONG`` by three of its words in
    a row, repeated items are found as often as they occur, repeated documents are reported once per row, rows with
    a missing key can't be named and are left to :func:`drop_leaks`; empty tables find nothing.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    found = None
    for ids, texts in _blocks(benchmark, item, item_text, block_words):
        items = Items(ids, texts, threshold)
        every = spark.sparkContext.broadcast(items.__dict__)
        counted = docs.select("text").mapInArrow(lambda bs, every=every: _counted(Items.of(every.value), bs), "at long, n long")
        counts = np.zeros(len(items.parts[2]["distinct"]), np.int64)
        for r in counted.groupBy("at").agg(F.sum("n").alias("n")).collect():  # at most block_words rows
            counts[r["at"]] = r["n"]
        items.keep_rare(counts)
        sent = spark.sparkContext.broadcast(items.__dict__)
        part = docs.mapInArrow(
            lambda bs, sent=sent: _findings(Items.of(sent.value), threshold, bs),
            "doc long, item long, score double, from_word long, to_word long",
        )
        part = materialise(part, "leaks")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "doc long, item long, score double, from_word long, to_word long")
    best = found.groupBy("doc", "item").agg(F.max(F.struct("score", "from_word", "to_word")).alias("b"))
    return best.select(F.col("doc").alias(key), F.col("item").alias(item), "b.score", "b.from_word", "b.to_word")


def drop_leaks(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents without those in which a test item was found; all columns as they came.

    The text alone decides, so rows are told apart by a hash of it: none is written for that.
    """
    known = free_name(documents, "_text_hash")
    hashed = documents.withColumn(known, F.xxhash64(text))
    leaks = find_leaks(hashed, benchmark, key=known, text=text, **options).select(known).distinct()
    return hashed.join(materialise(leaks, "leaking-texts"), known, "left_anti").select(documents.columns)
