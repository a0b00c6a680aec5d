"""Toxicity by classifier chains (operator 8).

Categories are predicted in the order of the chain. Each has a logistic model over the presence
of words and word beginnings (A-Z lower-cased) and over the probabilities of the categories before it.
In training those probabilities are out of fold: fold k's come from models fitted without fold k, so later links see
earlier ones as uncertain as they will be on new text.

The models are fitted on the driver from a sample of at most ``sample`` labelled rows, taken by a hash
of doc_id; ``FEATURES`` bounds what each looks at. Every document is scored by its whole text.

Labels that are null, or without a document, don't train. Without labels of both kinds a category
gets its share as constant probability (0.5 without any). Null texts are empty. Null ids are scored, not trained on.
Of several documents with a labelled doc_id, the one with the least features (as bytes) trains; equal label rows count once, different
ones for one id each. So the driver never gets more than ``sample`` rows. Very long texts are looked at whole, texts in slices of bounded size.
An empty table gives an empty result. Only the named columns are read, so others may have any name; ``drop_toxic`` passes all on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.words import Words, slices, trim

U = np.uint64
FEATURES = 400
LEAST = 3
FOLDS = 5
PREFIXES = (5, 7)
RIDGE = 0.1
TABLE_BITS = 20


def _presence(column: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Document indices and 32-bit features, distinct and sorted by document; only wanted ones (sorted) if given."""
    parts = [(at + doc, feature) for at, rows in slices(column) for doc, feature in (_presence_of(rows, wanted),)]
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2


def _presence_of(b: pa.Array, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    words = Words.of(b, lower=True, prefixes=PREFIXES)
    if not isinstance(words.hashes, list) or not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = words.document().astype(U) << U(32)
    if wanted is not None:
        table = np.zeros(1 << TABLE_BITS, bool)
        table[wanted & ((1 << TABLE_BITS) - 1)] = True
        parts = []
        for h in words.hashes:
            f = h >> U(32)
            some = np.flatnonzero(table[(f & U((1 << TABLE_BITS) - 1)).astype(np.int64)])
            parts.append(doc[some] | f[some])
        both = np.unique(np.concatenate(parts))
        f = (both & U(0xFFFFFFFF)).astype(np.int64)
        at = np.minimum(np.searchsorted(wanted, f), max(0, len(wanted) - 1))
        both = both[wanted[at] == f] if len(wanted) else both[:0]
    else:
        both = np.unique(np.concatenate([doc | (h >> U(32)) for h in words.hashes]))
    return (both >> U(32)).astype(np.int64), (both & U(0xFFFFFFFF)).astype(np.int64)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 12) -> np.ndarray:
    """Weights (the last is the intercept, not shrunk) by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-9), x.T @ (y - p) - shrink * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


class Link:
    """The model of one category: features, their weights, weights of earlier probabilities, intercept."""

    def __init__(self, doc: np.ndarray, feature: np.ndarray, y: np.ndarray, earlier: np.ndarray):
        self.features = np.zeros(0, np.int64)
        self.weights, self.chain = np.zeros(0), np.zeros(earlier.shape[1])
        share = y.mean() if len(y) else 0.5
        self.intercept = float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -8, 8))
        if len(set(y.tolist())) < 2:
            return
        names, code = np.unique(feature, return_inverse=True)
        n, a = np.bincount(code, minlength=len(names)), np.bincount(code, y[doc], minlength=len(names))
        expected = n * share
        odds = (a - expected) ** 2 / np.maximum(1e-9, expected * (1 - share) * (1 - n / (len(y) + 1)))
        odds[n < LEAST] = 0
        top = np.sort(np.lexsort((names, -odds))[:FEATURES])
        top = top[odds[top] > 8]
        self.features = names[top]
        x = self._matrix(doc, feature, len(y))
        w = logistic(np.hstack([x, earlier]), y)
        self.weights, self.chain, self.intercept = w[: len(top)], w[len(top) : -1], float(w[-1])

    def _matrix(self, doc, feature, n):
        x = np.zeros((n, len(self.features)))
        if len(self.features):
            at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            hit = self.features[at] == feature
            x[doc[hit], at[hit]] = 1
        return x

    def probability(self, doc: np.ndarray, feature: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        out = np.full(n, self.intercept) + earlier @ self.chain
        if len(self.features):
            at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            hit = self.features[at] == feature
            out += np.bincount(doc[hit], self.weights[at[hit]], n)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


class Chain:
    def __init__(self, links: list[Link]):
        self.links = links
        self.wanted = np.unique(np.concatenate([k.features for k in links] or [np.zeros(0, np.int64)]))

    @classmethod
    def fit(cls, doc: np.ndarray, feature: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> "Chain":
        """labels: documents x categories (0, 1; NaN where unknown)."""
        links: list[Link] = []
        earlier = np.zeros((len(labels), 0))
        for j in range(labels.shape[1]):
            y = labels[:, j]
            links.append(cls._link(doc, feature, y, earlier, ~np.isnan(y)))
            if j + 1 < labels.shape[1]:
                held = np.zeros(len(y))
                for k in range(FOLDS):
                    out = fold == k
                    held[out] = cls._link(doc, feature, y, earlier, ~np.isnan(y) & ~out).probability(doc, feature, len(y), earlier)[out]
                earlier = np.column_stack([earlier, held])
        return cls(links)

    @staticmethod
    def _link(doc, feature, y, earlier, rows) -> Link:
        new = np.cumsum(rows) - 1
        some = rows[doc]
        return Link(new[doc[some]], feature[some], y[rows], earlier[rows])

    def probabilities(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, 0))
        for link in self.links:
            out = np.column_stack([out, link.probability(doc, feature, n, out)])
        return out


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_col: str = "doc_id", text_col: str = "text", sample: int = 5000) -> Chain:
    """Fit on at most ``sample`` labelled rows, those with the least hash of their id."""
    known = labels.select(labels[id_col].cast("bigint").alias("id"), *[labels[c].cast("double").alias(f"y{j}") for j, c in enumerate(categories)])
    chosen = known.filter("id is not null").orderBy(F.xxhash64("id"), "id", *[f"y{j}" for j in range(len(categories))]).limit(sample)
    text = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, feature = _presence(b.column(1))
            edges = np.searchsorted(doc, np.arange(1, b.num_rows))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.astype("<u4").tobytes() for x in np.split(feature, edges)], pa.binary()), *b.columns[2:]], names=["id", "f", *b.schema.names[2:]])

    # the chosen rows, at most ``sample`` long numbers, are broadcast; their texts stay on the executors
    kinds = ", ".join(f"y{j} double" for j in range(len(categories)))
    found = text.join(F.broadcast(chosen), "id").mapInArrow(features, f"id bigint, f binary, {kinds}")
    rows = found.groupBy("id", *[f"y{j}" for j in range(len(categories))]).agg(F.min("f").alias("f")).toArrow()
    rows = rows.sort_by([(n, "ascending") for n in rows.column_names if n != "f"])
    y = np.column_stack([np.array(rows[f"y{j}"].to_pylist(), float) for j in range(len(categories))]) if len(rows) else np.zeros((0, len(categories)))
    ids = np.array(rows["id"].to_pylist(), np.int64)
    size = np.array([len(x) // 4 for x in rows["f"].to_pylist()], np.int64)
    feature = np.frombuffer(b"".join(rows["f"].to_pylist()), "<u4")
    del rows
    # features of fewer documents than LEAST can't be chosen; without them the rest is much smaller
    names, n = np.unique(feature, return_counts=True)
    often = np.isin(feature, names[n >= LEAST])
    doc = np.repeat(np.arange(len(size), dtype=np.int32), size)[often]
    return Chain.fit(doc, feature[often].astype(np.int64), y, (ids * 2654435761 >> 7) % FOLDS)


def score_toxicity(docs: DataFrame, chain: Chain, categories: Sequence[str], id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row a document: doc_id, p_<category> for each of the chain, rejected (the last is at the threshold or above)."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = ["doc_id", *[f"p_{c}" for c in categories], "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for b in batches:
            doc, feature = _presence(b.column(1), chain.wanted)
            p = chain.probabilities(doc, feature, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p[:, j]) for j in range(p.shape[1])), pa.array(p[:, -1] >= threshold)], names=names)

    kinds = ", ".join(f"{n} double" for n in names[1:-1])
    return docs.select(docs[id_col].cast("bigint"), docs[text_col]).mapInArrow(run, f"doc_id bigint, {kinds}, rejected boolean")


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they are, that score_toxicity doesn't reject."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for b in batches:
            doc, feature = _presence(b.column(at), chain.wanted)
            yield b.filter(pa.array(chain.probabilities(doc, feature, b.num_rows)[:, -1] < threshold))
            trim()

    return docs.mapInArrow(run, docs.schema)
