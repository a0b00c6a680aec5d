"""Token counts of sections by offset-mapped attribution (operator 5).

Each whole document is encoded once by a byte-level vocabulary. As its tokens' bytes are the text's bytes, the
spans of the tokens follow from their lengths; spans join the sections' intervals by search. A
token that crosses boundaries goes to one section by an explicit rule:

* ``largest``: the section with most of its bytes, the earlier one on a tie;
* ``first``: the section of its first byte.

So the counts of a document's sections add up to the tokens of the whole text. Sections are lines,
each with its line feed, or sentences: lines cut after each of ``.!?`` that a space follows, and that space. Tokens
that begin with that space cross the boundary. Null and empty texts are one empty section. Null or repeated ids are ids like others, repeated rows
give repeated rows. A very long text is encoded whole; others come in slices of 2 MB. An empty table gives an empty result. Only the two named columns
are read, so others may have any name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from galley.llm.words import slices, text_buffers

SCHEMA = "doc_id bigint, section int, start_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint"


@lru_cache
def vocabulary(path: str):
    """The encoder, and the bytes of each token."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def attribute(start: np.ndarray, end: np.ndarray, section_start: np.ndarray, section_end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether the token crosses a boundary. Sections tile the text."""
    first = np.searchsorted(section_start, start, side="right") - 1
    last = np.searchsorted(section_start, end - 1, side="right") - 1
    crossing = first != last
    out = first.copy()
    if rule == "largest":
        at = np.flatnonzero(crossing)
        most = np.zeros(len(at), np.int64)
        k = first[at].copy()
        while len(at):
            inside = np.minimum(end[at], section_end[k]) - np.maximum(start[at], section_start[k])
            better = inside > most
            out[at[better]] = k[better]
            most = np.maximum(most, inside)
            go = k < last[at]
            at, k, most = at[go], k[go] + 1, most[go]
    elif rule != "first":
        raise ValueError(f"unknown rule {rule}")
    return out, crossing


def boundaries(data: np.ndarray, offsets: np.ndarray, sections: str) -> np.ndarray:
    """Sorted starts of the sections of joined texts; the sections tile them."""
    cut = data == 10
    if sections == "sentences":
        stop = (data == 0x2E) | (data == 0x21) | (data == 0x3F)
        stop[offsets[1:][offsets[1:] > 0] - 1] = False
        cut[1:] |= stop[:-1] & (data[1:] == 0x20)
    inner = np.zeros(len(data) + 1, bool)
    inner[1:] = cut
    inner[offsets] = False
    inner[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(inner[: len(data)])


def section_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, rule: str = "largest", sections: str = "sentences") -> DataFrame:
    """One row a section: doc_id, section, start_char, end_char, n_tokens, n_crossing (of those, tokens
    that cross into or from another section), doc_tokens."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if rule not in ("largest", "first") or sections not in ("lines", "sentences"):
        raise ValueError(f"unknown rule {rule} or sections {sections}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = vocabulary(path)
        for b in batches:
            for at, texts in slices(b.column(1), 2 << 20):
                part = b.slice(at, len(texts))
                data, offsets = text_buffers(part.column(1))
                docs = part.num_rows
                ids = [encoding.encode_to_numpy(t, disallowed_special=()) if t else np.zeros(0, np.uint32) for t in part.column(1).to_pylist()]
                count = np.array([len(x) for x in ids], np.int64)
                end = np.cumsum(sizes[np.concatenate(ids)])
                start = np.concatenate([[0], end[:-1]])[: len(end)]
                section_start = boundaries(data, offsets, sections)
                section_end = np.append(section_start[1:], len(data))[: len(section_start)]
                doc = np.searchsorted(offsets, section_start, side="right") - 1
                to, crossing = attribute(start, end, section_start, section_end, rule)
                n, c = (np.bincount(to, w, len(section_start)).astype(np.int64) for w in (None, crossing))
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = chars[offsets[:-1]]
                a, z = chars[section_start] - base[doc], chars[section_end] - base[doc]
                empty = np.flatnonzero(np.diff(offsets) == 0)
                zero = np.zeros(len(empty), np.int64)
                nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
                all_ = [np.concatenate(x) for x in ((doc, empty), (nth, zero), (a, zero), (z, zero), (n, zero), (c, zero), (count[doc], zero))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(all_[0])), pa.array(all_[1].astype(np.int32)), *(pa.array(x) for x in all_[2:])],
                    names=["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"],
                )

    return docs.select(docs[id_col].cast("bigint"), docs[text_col]).mapInArrow(run, SCHEMA)
