"""MinHash near-dedup by a chosen-path set similarity join.

A document's set is its distinct 5-word shingles.  Documents with equal sets form
one class, represented by the smallest doc_id; the join runs on representatives.

* Every representative has ``MINHASHES`` minwise tokens.  A tree branches a node's
  documents by one minwise token; which one is a hash of the path so far, so each
  node chooses its own.  Spark counts the nodes level by level: single documents
  leave, nodes of at most ``NODE`` documents are leaves, larger ones branch again,
  down to a number of levels.  The trees start from different tokens: a pair at the
  threshold t shares a leaf of depth d in one tree with probability t^d, so all
  trees miss it with (1 - t^d)^trees.  ``FORESTS`` has (trees, levels) by threshold:
  at 0.85 under 1e-13 at depth 1, 1e-6 at depth 3 and 9e-5 at the last, 5; at 0.80
  under 1e-16 at depth 1, 1e-7 at depth 3 and 4e-6 at the last, 4.
* Leaves are compared exhaustively on one-byte sketches of the tokens.  The bar is
  so far below the threshold (``SLACK``) that a linked pair falls under it less
  than once in 10^5.  A node that is still large at the last level shares all its
  chosen tokens and is taken as similar as a whole.  This only forms groups of
  candidates, never results.
* Within a group all pairs are confirmed on the full sets.  Groups of more than
  ``BLOCK`` documents are cut into blocks, and each pair of blocks is its own
  piece of work, so no task holds a whole large group.
* Links become components by distributed star rounds.

Defined results: null, empty and word-less texts have 0 shingles, link to nothing
and are kept; a null doc_id links to nothing, has a null component and is kept;
rows that share a doc_id are one node; an empty table gives no rows; other columns
are ignored (``dedup`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, packed, stored, table
from .components import components

SHINGLE = 5
THRESHOLD = 85          # per cent, of the query
MINHASHES = 128
#: (lowest threshold in per cent, trees, levels)
FORESTS = ((85, 16, 5), (80, 24, 4))
NODE = 64
SLACK = 0.16
BLOCK = 256

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_A = np.random.default_rng(5).integers(1, 2**63, MINHASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``most`` words."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mix(x):
    x = x * _MIX
    return x ^ (x >> _SHIFT)


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "replace").translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    x = np.full(n, width, np.uint64)
    for k in range(width):
        x = _mix(x ^ h[k:k + n])
    return np.unique(x)


def minhashes(s: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set, as 32 bits of the smallest hash each."""
    low = np.full(MINHASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(s), 2048):
        np.minimum(low, (s[k:k + 2048] * _A[:, None]).min(axis=1), out=low)
    return (_mix(low) >> np.uint64(32)).astype(np.uint32)


def forest_of(threshold: int) -> tuple[int, int]:
    """(trees, levels) for a threshold in per cent."""
    for least, trees, depth in FORESTS:
        if threshold >= least:
            return trees, depth
    raise ValueError(f"no forest for a threshold of {threshold} per cent")


def paths(tokens: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Node ids of all trees and levels: (rows, trees, depth)."""
    rows = np.arange(len(tokens))[:, None]
    step = MINHASHES // trees
    p = np.broadcast_to(_mix(np.arange(1, trees + 1, dtype=np.uint64)), (len(tokens), trees))
    chosen = np.broadcast_to(np.arange(trees) * step, p.shape)
    out = np.empty((len(tokens), trees, depth), np.uint64)
    for level in range(depth):
        p = _mix(p ^ _mix(tokens[rows, chosen].astype(np.uint64) + np.uint64(level + 1)))
        out[:, :, level] = p
        chosen = ((p >> np.uint64(40)) % np.uint64(MINHASHES)).astype(np.int64)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, tokens) of every row."""
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            n, keys, tokens = [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t, hashes)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                tokens.append(minhashes(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.binary())],
                                             ["doc_id", "n_shingles", "set_key", "tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary, tokens binary")


def _tokens(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, MINHASHES)


def tree_roots(reps: DataFrame, trees: int, depth: int) -> DataFrame:
    """(doc_id, tree, node) at the first level of every tree."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                p = paths(_tokens(b.column("tokens")), trees, depth)[:, :, 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("doc_id").to_numpy(zero_copy_only=False), trees), pa.int64()),
                                                  pa.array(np.tile(np.arange(trees, dtype=np.int32), b.num_rows)), pa.array(p.ravel().view(np.int64))],
                                                 ["doc_id", "tree", "node"])

    return reps.mapInArrow(run, "doc_id bigint, tree int, node bigint")


def branches(shared: DataFrame, trees: int, depth: int) -> DataFrame:
    """``shared`` (doc_id, tree, node, size, tokens) with sketch and the deeper path."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                tokens = _tokens(b.column("tokens"))
                p = paths(tokens, trees, depth)[np.arange(b.num_rows), b.column("tree").to_numpy()]
                sketch = tokens.astype(np.uint8)
                below = p[:, 1:].view(np.int64)
                flat = pa.array(below.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (depth - 1)), flat)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("node"), b.column("size"), lists, pa.array([x.tobytes() for x in sketch], pa.binary())],
                                                 ["doc_id", "node", "size", "below", "sketch"])

    return shared.mapInArrow(run, "doc_id bigint, node bigint, size bigint, below array<bigint>, sketch binary")


class Forest:
    """Union-find over small integers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _runs(batches, keys):
    """Groups of consecutive rows with equal ``keys`` as one record batch each
    list; a group that spans batches is put together."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [*np.flatnonzero(new).tolist(), b.num_rows]
        for s, e in zip(starts, starts[1:], strict=False):
            key = tuple(c[s] for c in cols)
            if key != last and held:
                yield held
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield held


def _edges(pairs: list[tuple[int, int]]):
    a = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])


def leaf_edges(leaves: DataFrame, threshold: int) -> DataFrame:
    """Candidate edges (a, b): a spanning forest of every leaf's pairs whose
    sketches agree well enough."""
    bar = MINHASHES * (threshold / 100 - SLACK)

    def run(batches):
        out = []
        for parts in _runs(batches, ["node"]):
            ids = np.concatenate([p.column("doc_id").to_numpy(zero_copy_only=False) for p in parts])
            if len(ids) < 2:
                continue
            sk = np.frombuffer(b"".join(x for p in parts for x in p.column("sketch").to_pylist()), np.uint8).reshape(-1, MINHASHES)
            forest = Forest(len(ids))
            for k in range(len(ids) - 1):
                same = (sk[k + 1:] == sk[k]).sum(axis=1)
                for j in np.flatnonzero(same >= bar).tolist():
                    if forest.join(k, k + 1 + j):
                        out.append((ids[k], ids[k + 1 + j]))
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return leaves.repartition("node").sortWithinPartitions("node", "doc_id").mapInArrow(run, "a bigint, b bigint")


def candidate_edges(reps: DataFrame, threshold: int) -> DataFrame:
    """Edges (a, b) whose components hold every linked pair."""
    trees, depth = forest_of(threshold)
    roots = tree_roots(reps, trees, depth)
    sizes = roots.groupBy("tree", "node").agg(F.count("*").alias("size")).where("size > 1")
    shared = roots.join(sizes, ["tree", "node"])
    rows = branches(shared.join(reps, "doc_id").select("doc_id", "tree", "node", "size", "tokens"), trees, depth)
    rows = stored(rows, "tree-rows")
    leaves = rows.where(F.col("size") <= NODE).select("node", "doc_id", "sketch")
    found = leaf_edges(leaves, threshold)
    open_rows = rows.where(F.col("size") > NODE).select("doc_id", "below", "sketch")
    for level in range(depth - 1):
        at = open_rows.withColumn("node", F.col("below")[level])
        sizes = at.groupBy("node").agg(F.count("*").alias("size"), F.min("doc_id").alias("least")).where("size > 1")
        at = stored(at.join(sizes, "node"), "tree-level")
        found = found.union(leaf_edges(at.where(F.col("size") <= NODE).select("node", "doc_id", "sketch"), threshold))
        big = at.where(F.col("size") > NODE)
        open_rows = big.select("doc_id", "below", "sketch")
        if level == depth - 2:
            found = found.union(big.select(F.col("least").alias("a"), F.col("doc_id").alias("b")))
        elif big.isEmpty():
            break
    return found.where("a <> b").distinct()


def _confirm(ids: np.ndarray, sets: list[np.ndarray], out: list[tuple[int, int]], threshold: int) -> None:
    """Appends a spanning forest of the pairs with enough common shingles."""
    m, n = len(ids), np.array([len(s) for s in sets], np.int64)
    forest = Forest(m)
    if m <= 12:
        for i in range(m):
            for j in range(i + 1, m):
                if 100 * min(n[i], n[j]) < threshold * max(n[i], n[j]) or forest.root(i) == forest.root(j):
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= threshold * (n[i] + n[j] - both):
                    forest.join(i, j)
                    out.append((ids[i], ids[j]))
        return
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), n)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    both = np.zeros((m, m), np.float32)
    width = max(1, (1 << 22) // m)
    for lo in range(0, len(values), width):
        s, e = np.searchsorted(at, (lo, lo + width))
        has = np.zeros((m, min(width, len(values) - lo)), np.float32)
        has[owner[s:e], at[s:e] - lo] = 1
        both += has @ has.T
    both = both.astype(np.int64)
    linked = np.triu(100 * both >= threshold * (n[:, None] + n[None, :] - both), 1)
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        if forest.join(i, j):
            out.append((ids[i], ids[j]))


def confirmed_links(groups: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) on full sets inside the groups (node, component): a spanning
    forest of each piece of work."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    members = groups.join(sizes, "component").select("node", "component", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    # hashed onto blocks; a piece of work is an unordered pair of blocks
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def sets(batches):
        hashes = WordHashes()
        for b in batches:
            s = [shingles(t, hashes).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("component"), b.column("blocks"), b.column("block"), pa.array(s, pa.binary())],
                                             ["node", "component", "blocks", "block", "shingles"])

    texts = docs.select(F.col("doc_id").alias("node"), "text")
    # one plan at every size: texts and members meet by a shuffled join on the id
    rows = texts.join(members.hint("merge"), "node").select("node", "component", "blocks", "block", "text")
    rows = rows.mapInArrow(sets, "node bigint, component bigint, blocks int, block int, shingles binary")
    pieces = (rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "shingles"))

    def run(batches):
        out: list[tuple[int, int]] = []
        for parts in _runs(batches, ["component", "i", "j"]):
            ids = np.concatenate([p.column("node").to_numpy(zero_copy_only=False) for p in parts])
            _confirm(ids, [np.frombuffer(x, np.uint64) for p in parts for x in p.column("shingles").to_pylist()], out, threshold)
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return pieces.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``; documents
    whose similarity is ``threshold`` per cent or more are linked."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = stored(signatures(docs), "signatures")
    usable = sig.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    reps = stored(usable.join(classes, (usable["doc_id"] == classes["rep"]) & (usable["set_key"] == classes["set_key"]), "left_semi")
                  .select("doc_id", "tokens"), "representatives")
    groups = components(candidate_edges(reps, threshold))
    links = components(confirmed_links(groups, docs, threshold))
    # a class is the component of its representative; ids shared by several rows tie their classes together
    final = classes.join(links, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    return (sig.select("doc_id", "n_shingles", F.coalesce("set_key", F.concat(F.lit("empty"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("set_key"))
            .join(final, "set_key", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def dedup(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; of rows that repeat a
    kept doc_id, the first by text hash stays."""
    kept = near_duplicates(docs, threshold).where("kept and doc_id is not null").select("doc_id").distinct()
    rows = packed(docs, k=F.col("doc_id").cast("long"), t=F.xxhash64("text"))
    named = rows.where(F.col("k").isNotNull()).join(kept, F.col("k") == F.col("doc_id"), "left_semi")
    first = named.withColumn("nth", F.row_number().over(Window.partitionBy("k").orderBy("t"))).where("nth = 1")
    return first.select("row.*").unionByName(rows.where(F.col("k").isNull()).select("row.*"))


def op5_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, reach.r FROM reach JOIN l ON reach.doc_id = l.a),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
