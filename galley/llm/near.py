"""MinHash near-dedup by improved consistent weighted sampling (operator 2).

Texts with the same words are one node. Weights are TF-IDF over shingles of five words (A-Z lower-cased) of the nodes:
tf x (1 + IDF_SHARE ln(N/df)/ln(N)), N documents, df the exact number of nodes with the shingle. So exact copies don't
lower their own weight. Edited copies do: with a plain idf the words of a text edited into a third of all rows would weigh less than
each copy's few edits. README has recall and precision for other shares.

Signatures: a shingle of one node alone can't be a sample that two nodes share, so all such
shingles of a node draw one sample by their total weight, which has the distribution of the
least of theirs. Every other shingle is drawn by improved consistent weighted sampling.

J of two texts is at most the share of the weight that other texts have, too: texts for which that is below
the threshold have no link, and drop out before sampling.

Verification loses no link inside a bucket. (1) Every member is compared with the bucket's centre, the member with the
largest share of common weight. (2) A node's best linked centre, and that one's, name its root: nodes of one
root are in one class already. (3) A bucket that has several roots left is dealt into blocks of bounded size. The members outside its
most frequent root are queries; each block of them meets each block of the bucket once, as a matrix product, and links of different roots
come back, at most one for each pair of roots and block. No pair becomes a row. Links are joined to classes by alternating large and small stars.

Shingles are told apart by 48 bits: near 10^13 different ones some share a key, whose df is then too high by one or two.

Texts of fewer than five words have no shingles, so only equal words join them. Very long texts are one node each, in one chunk.
Null counts as empty. A null doc_id is the last choice. Repeated rows are members like others; of equal doc_ids the first row stays. An empty
table gives an empty result. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm import chunks as C
from galley.llm.components import connected_components
from galley.llm.quotient import CountingQuotientFilter as CQF
from galley.llm.quotient import pack_counts, pack_keys, unpack_counts, unpack_keys
from galley.llm.scratch import drop, materialize
from galley.llm.words import Words, mix, windows

U = np.uint64
KEY_BITS = 48
#: Members, and bytes of their vectors, in a block of a bucket.
BLOCK, BLOCK_BYTES = 512, 1 << 20
IDF_SHARE = 0.1
_G1, _G2 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
_REACH = 1e-9
SCHEMA = "doc_id bigint, node binary, first boolean, weight double, shared double, bands array<bigint>, vector binary"


def shingle_pairs(chunk: C.Chunk, words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle key, document) sorted by both, and how often each is there."""
    h, at = windows(words.hashes, words.first, n)
    doc = words.document()[at]
    if len(chunk.ids) <= 1 << (64 - KEY_BITS):
        both = np.sort(((h >> U(64 - KEY_BITS)) << U(64 - KEY_BITS)) | doc.astype(U))
        start = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
        tf = np.diff(np.append(start, len(both)))
        return both[start] >> U(64 - KEY_BITS), (both[start] & U((1 << (64 - KEY_BITS)) - 1)).astype(np.int64), tf
    key = h >> U(64 - KEY_BITS)
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order].astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(key) else np.zeros(0, np.int64)
    return key[start], doc[start], np.diff(np.append(start, len(key)))


def idf(df: np.ndarray, documents: int) -> np.ndarray:
    return 1 + IDF_SHARE * np.log(np.maximum(1, documents / df)) / np.log(max(2, documents))


def _uniform(bits: np.ndarray, shift: int) -> np.ndarray:
    return ((bits >> U(shift)) & U((1 << 21) - 1)).astype(np.float64) * 2.0**-21 + 2.0**-22


def signatures(key: np.ndarray, weight: np.ndarray, doc: np.ndarray, private: np.ndarray, node: np.ndarray, hashes: int) -> np.ndarray:
    """(documents x hashes) samples. key, weight, doc: shared shingles sorted by document; private:
    total weight of each document's other shingles; node: a hash of its words."""
    docs = len(private)
    out = np.empty((docs, hashes), U)
    start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    owner = doc[start]
    log_weight = np.log(weight)
    with np.errstate(divide="ignore"):
        log_private = np.log(private)
    for k in range(hashes):
        salt = mix(np.array([k + 1], U) * _G2)[0]
        own = mix(node ^ salt)
        best = np.log(-np.log(_uniform(own, 0))) - log_private
        out[:, k] = mix(own)
        if len(start):
            a, b = mix(key * _G1 ^ salt), mix(key * _G2 ^ salt)
            r = -np.log(_uniform(a, 0) * _uniform(a, 21))
            beta = _uniform(a, 42)
            t = np.floor(log_weight / r + beta)
            log_a = np.log(-np.log(_uniform(b, 0) * _uniform(b, 21))) - r * (t - beta + 1)
            least = np.minimum.reduceat(log_a, start)
            at = np.flatnonzero(log_a == np.repeat(least, np.diff(np.append(start, len(doc)))))[::-1]
            first = np.empty(docs, np.int64)
            first[doc[at]] = at
            wins = least < best[owner]
            i = first[owner[wins]]
            out[owner[wins], k] = mix(key[i] ^ (t[i].astype(np.int64).view(U) * _G1) ^ salt)
    return out


def _pack_vector(key: np.ndarray, tf: np.ndarray, df: np.ndarray) -> bytes:
    return pack_keys(key, KEY_BITS) + pack_counts(tf) + pack_counts(df)


def _vector(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, at = unpack_keys(body)
    tf, at = unpack_counts(body, len(key), at)
    return key, tf, unpack_counts(body, len(key), at)[0]


def shared_weight(a: tuple, b: tuple, documents: int) -> float:
    """The weight that two vectors (key, tf, df) have in common."""
    (ka, ta, da), (kb, tb, _) = a, b
    at = np.searchsorted(kb, ka)
    at[at == len(kb)] = 0
    both = kb[at] == ka if len(kb) else np.zeros(len(ka), bool)
    return float((np.minimum(ta[both], tb[at[both]]) * idf(da[both], documents)).sum())


def _digests(words: Words) -> np.ndarray:
    """Two independent hashes over each document's words, which name its node."""
    step = np.arange(len(words.hashes), dtype=U) - words.first[:-1].astype(U)[words.document()]
    out = []
    for salt in (_G1, _G2):
        run = np.concatenate([np.zeros(1, U), np.cumsum(mix((words.hashes ^ salt) + mix(step * salt)))])
        out.append(mix((run[words.first[1:]] - run[words.first[:-1]]) ^ words.counts.astype(U)))
    return np.stack(out, 1)


def _only(words: Words, docs: np.ndarray) -> Words:
    """The same documents, but only those chosen have words."""
    out = object.__new__(Words)
    at = docs[words.document()]
    out.data, out.starts, out.ends, out.hashes = words.data, words.starts[at], words.ends[at], words.hashes[at]
    out.first = np.concatenate([[0], np.cumsum(np.where(docs, words.counts, 0))])
    return out


def sampled(docs: DataFrame, id_col: str, text_col: str, words_in_shingle: int, bands: int, rows: int, threshold: float) -> tuple[DataFrame, int]:
    """The number of documents, and one row for each: node (digest of its words), first (true for one document of each node). For that one: total weight, the
    weight that other nodes have, too (shared), band hashes and vector of the shingles that other nodes have; bands and vector are null where
    those weigh less than threshold of the total: J is at most that share, so the node has no link."""
    size = C.layout(docs, text_col)
    bits, documents = size.bits, size.rows
    stored = C.store(docs, id_col, text_col, size.chunks)

    def emit_nodes(_, chunk: C.Chunk):
        own = np.unique(_digests(Words(chunk.data, chunk.offsets, lower=True)), axis=0)
        edges = np.searchsorted(own[:, 0], np.arange(1, 1 << bits, dtype=U) << U(64 - bits))
        for b, part in enumerate(np.split(own, edges)):
            if len(part):
                yield b, part.tobytes()

    def merge_nodes(bodies: list[bytes]) -> list[bytes]:
        """One bit a node: whether this chunk is the one that speaks for it. All nodes of a bucket come in the order of their chunks."""
        parts = [np.frombuffer(x, U).reshape(-1, 2) for x in bodies]
        _, first = np.unique(np.concatenate(parts), axis=0, return_index=True)
        mine = np.zeros(sum(len(x) for x in parts), bool)
        mine[first] = True
        return [C.pack_bits(x) for x in np.split(mine, np.cumsum([len(x) for x in parts])[:-1])]

    def speakers(digest: np.ndarray, bits_of_nodes: np.ndarray) -> np.ndarray:
        """The chunk's documents that speak for their node. The bits are in the order of nodes, not of documents, so it doesn't matter
        in which order equal documents come."""
        _, first = np.unique(digest, axis=0, return_index=True)
        out = np.zeros(len(digest), bool)
        out[first[bits_of_nodes]] = True
        return out

    def emit(k: int, chunk: C.Chunk, answers: dict[int, bytes]):
        words = Words(chunk.data, chunk.offsets, lower=True)
        mine = C.read_bits(answers)
        speaks = speakers(_digests(words), mine)
        key, _doc, _tf = shingle_pairs(chunk, _only(words, speaks), words_in_shingle)
        for b, part in enumerate(CQF.build(key, KEY_BITS).split(bits)):
            if len(part.keys):
                yield b, part.to_bytes()
        yield C.note(k, C.pack_bits(mine))

    def merge(bodies: list[bytes]) -> list[bytes]:
        return [struct.pack("<I", len(x)) + pack_counts(x) for x in CQF.totals([CQF.from_bytes(x) for x in bodies])]

    def last(chunk: C.Chunk, answers: dict[int, bytes]) -> pa.Table:
        whole = Words(chunk.data, chunk.offsets, lower=True)
        nodes = _digests(whole)
        speaks = speakers(nodes, C.unpack_bits(answers[-1]))
        words = _only(whole, speaks)
        key, doc, tf = shingle_pairs(chunk, words, words_in_shingle)
        totals = [unpack_counts(answers[b], struct.unpack_from("<I", answers[b])[0], 4)[0] for b in sorted(answers) if b >= 0]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        df = (np.concatenate(totals) if totals else np.zeros(0, np.int64))[np.cumsum(new) - 1]
        order = np.argsort(doc.astype(np.uint16) if len(chunk.ids) <= 65536 else doc, kind="stable")
        key, doc, tf, df = key[order], doc[order], tf[order], df[order]
        weight = tf * idf(df, documents)
        n = len(chunk.ids)
        total = np.bincount(doc, weight, n)
        shared = df > 1
        private = np.bincount(doc[~shared], weight[~shared], n)
        linkable = (total - private >= threshold * total * (1 - _REACH)) & (total > 0)
        alive = shared & linkable[doc]
        key, doc, tf, df, weight = (x[alive] for x in (key, doc, tf, df, weight))
        sample = signatures(key, weight, doc, private, nodes[:, 0], bands * rows)
        band = np.zeros((n, bands), U)
        for j in range(bands):
            h = np.full(n, j + 1, U)
            for k in range(j * rows, (j + 1) * rows):
                h = mix(h * _G1 ^ sample[:, k])
            band[:, j] = h
        edges = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).tolist()
        vectors = [_pack_vector(key[a:b], tf[a:b], df[a:b]) if a < b else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
        some = np.diff(edges) > 0
        at = np.concatenate([[0], np.cumsum(some)]).astype(np.int32) * bands
        lists = pa.ListArray.from_arrays(pa.array(at, mask=np.append(~some, False)), pa.array(band[some].view(np.int64).ravel()))
        return pa.table(
            [
                chunk.id_column(),
                pa.array([x.tobytes() for x in nodes], pa.binary()),
                pa.array(speaks),
                pa.array(total),
                pa.array(total - private),
                lists,
                pa.array(vectors, pa.binary()),
            ],
            names=["doc_id", "node", "first", "weight", "shared", "bands", "vector"],
        )

    nodes = C.answer(C.send(stored, emit_nodes), merge_nodes)
    return C.finish(stored, C.answer(C.send_again(stored, nodes, emit), merge), last, SCHEMA), documents


def _verified(pairs: DataFrame, vectors: DataFrame, threshold: float, documents: int) -> DataFrame:
    """node, center, trust of the pairs with a J of at least threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None  # rows come sorted by centre, so a centre is unpacked once
        for b in batches:
            near = np.empty(b.num_rows, bool)
            for at in range(0, b.num_rows, 256):
                rows = zip(*(b.column(i).slice(at, 256).to_pylist() for i in (1, 3, 4, 5, 6)), strict=True)
                for i, (center, va, wa, vb, wb) in enumerate(rows, at):
                    if center != last:
                        last, held = center, _vector(vb)
                    common = shared_weight(_vector(va), held, documents)
                    near[i] = common >= (threshold - _REACH) * (wa + wb - common)
            yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(near)) for i in range(3)], names=["node", "center", "trust"])

    left = vectors.select("node", F.col("vector").alias("va"), F.col("weight").alias("wa"))
    right = vectors.select(F.col("node").alias("center"), F.col("vector").alias("vb"), F.col("weight").alias("wb"))
    joined = pairs.join(left, "node").join(right, "center").select("node", "center", "trust", "va", "wa", "vb", "wb")
    return joined.mapInArrow(run, "node binary, center binary, trust double")


def _elements(vectors: list[tuple], documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector, element, weight) of a block: a shingle that a text has k times is k elements, so that the least of two
    frequencies is the size of an intersection."""
    size = [len(v[0]) for v in vectors]
    owner = np.repeat(np.arange(len(vectors)), size)
    key, tf, df = (np.concatenate([v[i] for v in vectors]) for i in range(3))
    at = np.repeat(np.arange(len(key)), tf)
    copy = np.arange(len(at)) - np.repeat(np.cumsum(tf) - tf, tf)
    return owner[at], mix(key[at] * _G1 + copy.astype(U)), idf(df, documents)[at]


def common_weights(vectors: list[tuple], a: np.ndarray, b: np.ndarray, documents: int) -> np.ndarray:
    """The weight in common of each vector of a and each of b, by matrix products over slices of the elements."""
    owner, element, weight = _elements(vectors, documents)
    code, first, element = np.unique(element, return_index=True, return_inverse=True)
    row = {}
    for side, chosen in (("a", a), ("b", b)):
        row[side] = np.full(len(vectors), -1)
        row[side][chosen] = np.arange(len(chosen))
    both = np.bincount(element[row["a"][owner] >= 0], minlength=len(code)).astype(bool) & np.bincount(element[row["b"][owner] >= 0], minlength=len(code)).astype(bool)
    place = np.cumsum(both) - 1
    out = np.zeros((len(a), len(b)))
    width = 4096
    use = both[element]
    owner, element = owner[use], place[element[use]]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    value = weight[first[both]].astype(np.float32)
    for lo in range(0, len(value), width):
        s, e = np.searchsorted(element, [lo, lo + width])
        m = {}
        for side, n in (("a", len(a)), ("b", len(b))):
            r = row[side][owner[s:e]]
            m[side] = np.zeros((n, min(width, len(value) - lo)), np.float32)
            m[side][r[r >= 0], element[s:e][r >= 0] - lo] = 1
        out += (m["a"] * value[lo : lo + width]) @ m["b"].T
    return out


def _block_links(threshold: float, documents: int):
    """Links (node, center) of different roots between the queries and the members of one block pair."""

    def run(table: pa.Table) -> pa.Table:
        column = lambda c: table[c].to_numpy()
        query, base, weight, shared = column("query"), column("base"), column("weight"), column("shared")
        node, root = table["node"].to_pylist(), table["root"].to_pylist()
        code = {r: i for i, r in enumerate(dict.fromkeys(root))}
        root = np.array([code[r] for r in root], np.int64)
        a, b = np.flatnonzero(query), np.flatnonzero(base)
        out = []
        if len(a) and len(b):
            w = weight[a][:, None] + weight[b]
            # J is at most the ratio of the weights, and two texts have at most the lesser of their shared weights in common
            possible = (root[a][:, None] != root[b]) & (np.minimum(weight[a][:, None], weight[b]) >= threshold * (1 - _REACH) * np.maximum(weight[a][:, None], weight[b]))
            possible &= (1 + threshold) * (1 + _REACH) * np.minimum(shared[a][:, None], shared[b]) >= threshold * w
            ra, rb = possible.any(1), possible.any(0)
            a, b, w, possible = a[ra], b[rb], w[np.ix_(ra, rb)], possible[np.ix_(ra, rb)]
        if len(a) and len(b):
            chosen, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            vectors = [_vector(table["vector"][int(i)].as_py()) for i in chosen]
            common = common_weights(vectors, place[: len(a)], place[len(a) :], documents)
            j = common / (w - common)
            near = possible & (j >= threshold + 1e-4)
            for i, k in np.argwhere(possible & ~near & (j >= threshold - 1e-4)):  # single precision doesn't tell
                exact = shared_weight(vectors[place[i]], vectors[place[len(a) + k]], documents)
                near[i, k] = exact >= (threshold - _REACH) * (w[i, k] - exact)
            parent = np.arange(len(code))

            def find(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i in np.flatnonzero(near.any(1)):
                found = b[near[i]]
                for r, at in zip(*np.unique(root[found], return_index=True), strict=True):
                    x, y = find(root[a[i]]), find(r)
                    if x != y:
                        parent[x] = y
                        out.append((node[a[i]], node[found[at]]))
        u, v = zip(*out, strict=True) if out else ((), ())
        return C.trimmed(pa.table([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["node", "center"]))

    return run


def near_links(nodes: DataFrame, threshold: float, documents: int) -> DataFrame:
    """Verified links (node, center) between nodes (columns node, bands, vector, weight, shared): as many as give the
    components that all links inside buckets would give."""
    vectors = nodes.select("node", "vector", "weight")
    trust = F.col("shared") / F.col("weight")
    banded = nodes.select("node", "weight", "shared", F.octet_length("vector").alias("size"), F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("weight").alias("least"), F.max(F.struct(trust.alias("trust"), "node", "weight", "shared")).alias("c")).filter("n > 1")
    # J >= t asks of a partner a weight of at most (1 + t)/t times one's shared weight less one's own
    room = F.lit((1 + threshold) / threshold * (1 + _REACH)) * F.col("shared") - F.col("weight")
    members = materialize(banded.join(buckets, "bucket").filter(room >= F.col("least")).select("bucket", "n", "node", "weight", "shared", "size", "c"), "members")

    others = members.filter("node <> c.node")
    w, cw = F.col("weight"), F.col("c.weight")
    possible = (F.least(w, cw) >= F.lit(threshold * (1 - _REACH)) * F.greatest(w, cw)) & (F.least("shared", "c.shared") * F.lit((1 + threshold) * (1 + _REACH)) >= F.lit(threshold) * (w + cw))
    pairs = others.filter(possible).select("node", F.col("c.node").alias("center"), F.col("c.trust").alias("trust")).distinct()
    first = materialize(_verified(pairs, vectors, threshold, documents), "first")

    up = first.groupBy("node").agg(F.max(F.struct("trust", "center")).alias("up")).select("node", F.col("up.center").alias("up"))
    top = materialize(up.join(up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up", "left").select("node", F.coalesce("top", "up").alias("top")), "top")
    rooted = others.filter("n > 2").drop("c", "n").join(top, "node", "left").withColumn("root", F.coalesce("top", "node")).drop("top")
    of_root = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    open_ = of_root.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "root", "bytes")).alias("main")).filter("n > main.n")
    parts = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("int")
    open_ = open_.select(
        "bucket", F.col("main.root").alias("main"), parts(F.col("n"), F.col("bytes")).alias("blocks"), parts(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("queries")
    )
    here = rooted.join(open_, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("asks", F.when(F.col("root") != F.col("main"), F.pmod(F.xxhash64("node", F.lit(1)), "queries").cast("int")))
    as_base = F.transform(F.sequence(F.lit(0), F.col("queries") - 1), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
    as_query = F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != F.col("block")), lambda j: F.struct(F.col("asks").alias("i"), j.alias("j")))
    dealt = here.withColumn("at", F.explode(F.when(F.col("asks").isNull(), as_base).otherwise(F.concat(as_base, as_query))))
    dealt = dealt.select("bucket", "at.i", "at.j", "node", "root", "shared", F.coalesce(F.col("asks") == F.col("at.i"), F.lit(False)).alias("query"), (F.col("block") == F.col("at.j")).alias("base"))
    second = materialize(dealt.join(vectors, "node").groupBy("bucket", "i", "j").applyInArrow(_block_links(threshold, documents), "node binary, center binary"), "second")
    links = materialize(first.select("node", "center").unionByName(second).distinct(), "links")
    drop(members, first, top, second)
    return links


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, words_in_shingle: int = 5, bands: int = 12, rows: int = 3) -> DataFrame:
    """One row a document: doc_id, class_id (the smallest doc_id of its class), class_size, kept (true
    for one row of each class, that of class_id)."""
    found, documents = sampled(docs, id_col, text_col, words_in_shingle, bands, rows, threshold)
    table = materialize(found.withColumn("row", F.monotonically_increasing_id()), "sampled")
    links = near_links(table.filter("vector is not null").select("node", "bands", "vector", "weight", "shared"), threshold, documents)
    roots = connected_components(links, "node", "center")  # node, root
    rank = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id"), F.col("row"))
    first = table.groupBy("node").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    named = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = named.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("class_size"))
    by_node = materialize(named.select("node", "root").join(classes, "root").select("node", "first", "class_size"), "classes")
    drop(links, roots)
    return table.select("doc_id", "row", "node").join(by_node, "node").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("kept")
    )
