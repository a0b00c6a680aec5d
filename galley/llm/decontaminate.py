"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman (operator 3).

1. The benchmark comes to the driver in blocks of at most ``block_words`` words; each block makes one pair of
   scans, so what is broadcast is bounded however large the benchmark is.
2. One scan counts the block's words over all documents. An n-gram is rare if the product of its
   words' rates is at most ``rare``: a rate, so corpus size doesn't matter, and a product of word rates, so a leak
   that was copied often doesn't hide itself. A leak hot enough makes its own words frequent, so an item with four
   n-grams in a row that aren't rare (or with fewer in all, none of them rare) uses all its n-grams. Two or three words
   within n positions are seeds as well if the product of their rates is as small, so copies edited every few words are reached.
3. One scan finds seed hits in whole documents, joins hits on neighbouring diagonals to
   a passage, and aligns it with the item by words (A-Z lower-cased): match 2, mismatch -1, gap -1. The score over
   twice the item's words is 1 for a whole copy. Passages of at least ``threshold`` are returned.

Items of fewer than n words are matched as wholes only: a text of the same words always, and the words in a row inside a text
if there are two or more and the product of their rates is at most ``rare`` (else they can't be told from chance). Null texts are empty. Null or
repeated ids are ids like others; rows that repeat both ids give one row with all their passages. Of passages with the best score, that which starts last is
given. Very long texts are looked at whole, batches in slices of bounded bytes. Empty tables give an empty result. Only the named columns are read,
so others may have any name; ``drop_contaminated`` passes all on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.words import Words, mix, slices, trim

U = np.uint64
MATCH, MISMATCH, GAP = 2, -1, -1
TABLE_BITS = 20
#: Places of the words of shorter seeds; a seed of n words comes first.
SHORT = [(0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1), (0, 2), (0, 3)]
BASE = U(0x9E3779B97F4A7C15 | 1)
SCHEMA = "doc_id bigint, item_id bigint, score double, start_word bigint, end_word bigint"


def patterns(n: int) -> list[tuple[int, ...]]:
    return [tuple(range(n)), *(p for p in SHORT if p[-1] < n and len(p) < n)]


def grams(hashes: np.ndarray, pattern: tuple[int, ...]) -> np.ndarray:
    """The hash of the words at the places of a pattern from each start, whether or not they lie in one document."""
    m = max(0, len(hashes) - pattern[-1])
    h = np.zeros(m, U)
    for k in pattern:
        h *= BASE
        h += hashes[k : k + m]
    return mix(h ^ U(sum(1 << k for k in pattern)))


def room(first: np.ndarray) -> np.ndarray:
    """How many words each document still has from each word on."""
    return np.repeat(first[1:], np.diff(first)) - np.arange(first[-1] if len(first) else 0)


class Items:
    """A block of benchmark items: ids and hashed words, seeds and their rates."""

    def __init__(self, ids: list, texts: list[str | None], n: int):
        words = Words.of(pa.array(texts, pa.string()), lower=True)
        self.ids, self.words, self.first = ids, words.hashes, words.first
        self.document, self.room = words.document(), room(words.first)
        self.vocabulary = np.unique(words.hashes)
        self.n = n

    def keep_rare(self, counts: np.ndarray, total: int, rare: float, least: int = 4) -> None:
        rate = np.log((counts + 0.5) / (total + 0.5 * (len(counts) + 1)))[np.searchsorted(self.vocabulary, self.words)]
        size = np.diff(self.first)[self.document]
        found = []
        for pattern in patterns(self.n):
            # a short item is a seed as a whole only
            start = np.flatnonzero((self.room > pattern[-1]) & ((size >= self.n) | (size == self.room) & (size == len(pattern)) & (size == pattern[-1] + 1)))
            item = self.document[start]
            good = sum((rate[start + k] for k in pattern), np.zeros(len(start))) <= np.log(rare)
            if not found:
                at, before = np.arange(len(good)), np.append(0, np.cumsum(good))
                first, end = (np.searchsorted(item, item, side=s) for s in ("left", "right"))
                stop = at + np.minimum(least, end - first)
                # (no short item has a start here, as this pattern has n words)
                bare = np.zeros(len(self.ids), bool)
                bare[item[(stop <= end) & (before[np.minimum(stop, len(good))] == before[at])]] = True
                good |= bare[item]
            found.append((grams(self.words, pattern)[start[good]], start[good], item[good]))
        gram, at, item = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(gram, kind="stable")
        self.gram, self.at, self.item = gram[order], at[order], item[order]

    def table(self) -> np.ndarray:
        """A bitmap of the seeds' low bits, sparse however many there are."""
        table = np.zeros(1 << max(TABLE_BITS, (8 * len(self.gram)).bit_length()), bool)
        table[(self.gram & U(len(table) - 1)).astype(np.int64)] = True
        return table


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each row pair, and the column of b where it ends. Rows are padded by 0 in
    a and 1 in b, which match nothing. The gap along a row is a running maximum, so a row is a few array operations."""
    n, width = b.shape
    ramp = np.arange(width, dtype=np.int32) * -GAP
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(a.shape[1]):
        here = np.where(a[:, i, None] == b, MATCH, MISMATCH).astype(np.int32)
        here += above[:, :-1]
        np.maximum(here, above[:, 1:] + GAP, out=here)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here + ramp, axis=1) - ramp
        at = here.argmax(1)
        top = here[np.arange(n), at]
        better = (top > best) & (a[:, i] != 0)
        best[better], end[better] = top[better], at[better]
        above[:, 1:] = here
    return best, end


def _padded(words: np.ndarray, start: np.ndarray, stop: np.ndarray, fill: int, back: bool) -> np.ndarray:
    width = int((stop - start).max(initial=1))
    at = np.arange(width)
    inside = at < (stop - start)[:, None]
    index = (stop[:, None] - 1 - at) if back else (start[:, None] + at)
    return np.where(inside, words[np.where(inside, index, 0)], U(fill))


def align(items: np.ndarray, a0: np.ndarray, a1: np.ndarray, text: np.ndarray, b0: np.ndarray, b1: np.ndarray, cells: int = 2_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, first and last+1 word of b's best local alignment with a, for each pair of word ranges."""
    score, first, last = (np.zeros(len(a0), np.int64) for _ in range(3))
    order = np.lexsort((a1 - a0, b1 - b0))
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (b1 - b0)[order[stop]] * (stop + 1 - at) <= cells:
            stop += 1
        k = order[at:stop]
        s, e = smith_waterman(_padded(items, a0[k], a1[k], 0, False), _padded(text, b0[k], b1[k], 1, False))
        _, r = smith_waterman(_padded(items, a0[k], a1[k], 0, True), _padded(text, b0[k], b1[k], 1, True))
        score[k], last[k], first[k] = s, b0[k] + e + 1, b1[k] - 1 - r
        at = stop
    return score, first, last


def whole_texts(words: Words, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Document and item indices of texts that are short items, word for word."""
    found = []
    for k in range(1, items.n):
        name = lambda hashes, at: grams(hashes, tuple(range(k)))[at] if len(at) else np.zeros(0, U)  # noqa: B023, E731
        docs, of = (np.flatnonzero(np.diff(x) == k) for x in (words.first, items.first))
        text, item = name(words.hashes, words.first[docs]), name(items.words, items.first[of])
        order = np.argsort(item, kind="stable")
        lo, hi = (np.searchsorted(item[order], text, side=s) for s in ("left", "right"))
        n = hi - lo
        found.append((np.repeat(docs, n), of[order][np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def find_passages(words: Words, items: Items, table: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """Document index, item index, score, first and last+1 word (in the document) of passages."""
    left, hits = room(words.first), []
    for pattern in patterns(items.n):
        gram = grams(words.hashes, pattern)
        some = np.flatnonzero(table[(gram & U(len(table) - 1)).astype(np.int64)])
        some = some[left[some] > pattern[-1]]
        hits.append((gram[some], some))
    gram, some = (np.concatenate(x) for x in zip(*hits, strict=True))
    lo, hi = (np.searchsorted(items.gram, gram, side=s) for s in ("left", "right"))
    count = hi - lo
    where = np.repeat(some, count)
    seed = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    item = items.item[seed]
    diagonal = where - (items.at[seed] - items.first[item])
    doc = np.searchsorted(words.first, where, side="right") - 1
    order = np.lexsort((diagonal, item, doc))
    doc, item, diagonal = doc[order], item[order], diagonal[order]
    size = np.diff(items.first)
    slack = size[item] // 4 + 2
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[1:])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(doc)) - 1 if len(start) else start
    doc, item, slack = doc[start], item[start], slack[start]
    b0 = np.maximum(words.first[doc], diagonal[start] - slack)
    b1 = np.minimum(words.first[doc + 1], diagonal[stop] + size[item] + slack)
    score, first, last = align(items.words, items.first[item], items.first[item + 1], words.hashes, b0, b1)
    share = score / (MATCH * np.maximum(1, size[item]))
    good = share >= threshold
    found = doc[good], item[good], share[good], (first - words.first[doc])[good], (last - words.first[doc])[good]
    doc, item = whole_texts(words, items)
    fresh = ~np.isin(doc * len(items.ids) + item, found[0] * len(items.ids) + found[1])
    doc, item = doc[fresh], item[fresh]
    return tuple(np.concatenate(x) for x in zip(found, (doc, item, np.ones(len(doc)), np.zeros(len(doc), np.int64), size[item]), strict=True))


def _blocks(benchmark: DataFrame, n: int, block_words: int) -> Iterator[Items]:
    ids, texts, size = [], [], 0
    for r in benchmark.toLocalIterator():
        words = len((r[1] or "").split())
        if ids and size + words > block_words:
            yield Items(ids, texts, n)
            ids, texts, size = [], [], 0
        ids.append(r[0])
        texts.append(r[1])
        size += words
    if ids:
        yield Items(ids, texts, n)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 4, rare: float = 1e-9, threshold: float = 0.5, block_words: int = 500_000) -> DataFrame:
    """One row a document and item with an aligned passage: doc_id, item_id, score (the best), start_word,
    end_word (of the best), n_passages."""
    spark = docs.sparkSession
    text = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    out = None
    for items in _blocks(benchmark.select(benchmark[item_col].cast("bigint"), benchmark[item_text]), n, block_words):
        counts, total = _count_words(text, items.vocabulary)
        items.keep_rare(counts, total, rare)
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            table = items.table()
            item_ids = pa.array(items.ids, pa.int64())
            for b in batches:
                parts = [(at + doc, *more) for at, part in slices(b.column(1)) for doc, *more in (find_passages(Words.of(part, lower=True), items, table, threshold),)]
                if not parts:
                    continue
                doc, item, score, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), item_ids.take(pa.array(item)), *(pa.array(x) for x in (score, first, last))], names=["doc_id", "item_id", "score", "start_word", "end_word"])
                trim()

        found = text.mapInArrow(run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], SCHEMA)
    best = F.max(F.struct("score", "start_word", "end_word")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best, F.count(F.lit(1)).alias("n_passages")).select("doc_id", "item_id", "best.score", "best.start_word", "best.end_word", "n_passages")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 4, rare: float = 1e-9, threshold: float = 0.5, block_words: int = 500_000) -> DataFrame:
    """The rows of docs, all columns as they are, that hold no aligned passage of the benchmark."""
    spark = docs.sparkSession
    at, out = docs.columns.index(text_col), docs
    text = docs.select(F.lit(0).alias("id"), docs[text_col].alias("text"))
    for items in _blocks(benchmark.select(benchmark[item_col].cast("bigint"), benchmark[item_text]), n, block_words):
        counts, total = _count_words(text, items.vocabulary)
        items.keep_rare(counts, total, rare)
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            table = items.table()
            for b in batches:
                good = np.ones(b.num_rows, bool)
                for begin, part in slices(b.column(at)):
                    good[begin + find_passages(Words.of(part, lower=True), items, table, threshold)[0]] = False
                yield b.filter(pa.array(good))
                trim()

        out = out.mapInArrow(run, docs.schema)
    return out


def _count_words(text: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """How often all documents have each word of the block's vocabulary, and all their words."""
    shared = text.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        table = np.zeros(1 << TABLE_BITS, bool)
        table[(vocabulary & U((1 << TABLE_BITS) - 1)).astype(np.int64)] = True
        counts, total = np.zeros(len(vocabulary), np.int64), 0
        for b in batches:
            for _, part in slices(b.column(0)):
                h = Words.of(part, lower=True).hashes
                total += len(h)
                h = h[table[(h & U((1 << TABLE_BITS) - 1)).astype(np.int64)]]
                at = np.minimum(np.searchsorted(vocabulary, h), max(0, len(vocabulary) - 1))
                counts += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary)) if len(vocabulary) else 0
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], total))], names=["word", "n"])

    out, total = np.zeros(len(vocabulary), np.int64), 0
    for r in text.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator():
        if r.word < 0:
            total = r.n
        else:
            out[r.word] = r.n
    return out, total
