"""Language-model scores: prediction by partial matching (``ppm``) trained on the
corpus, beside a smoothed unigram base.

1. Token counts over all training documents, pre-aggregated per task.
2. Context counts over all distinct tokens, weighted by their counts; none is left out.
   Contexts of under ``LOCAL`` bytes are one small trie (at most 256 ** LOCAL pairs), which
   is broadcast.
3. Every distinct token of the corpus gets its code length once.  Its bytes with a context
   of ``LOCAL`` bytes or more meet in the group of the last ``LOCAL`` bytes of their
   contexts: there lie all longer contexts that a code length needs, so a group counts
   them whole and codes its bytes.  A token's code length is the sum over its bytes.
4. The same model over whole texts (``stream_score``): its contexts run over the blanks, back
   to the text's start at most.  A byte with its context is one number, the key; a task
   counts the keys of its texts and deals them to parts by the last ``LOCAL`` bytes of
   their contexts, so a part counts its longer contexts whole and every distinct key of the
   corpus gets its code length once.
5. Documents look up the head of the token table (at most ``HEAD`` tokens, broadcast) and
   of the keys (at most ``STREAM_HEAD``) while they are read; their other tokens and keys are
   joined with the whole tables by a shuffled join.  Sums per document give the scores.

Defined results: null and empty texts are the end token alone; a null doc_id's
crc32 is that of an empty text, so the row is held out; rows that repeat an id are
scored one by one; with no training tokens every probability is the uniform one;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ppm
from .common import ASCII_LOWER, discard, scratch, shuffles_dropped, stored, table

#: The share of the training bytes below which a (context, symbol) pair is not counted: all are.
SHARE = 0.0
HEAD = 1 << 18
FLUSH = 400_000
LOCAL = 3
#: Bytes coded at a time, unless a group has more.
CHUNK = 500_000
#: Keys of whole texts in the broadcast head, and bytes of texts whose keys are made at a time.
STREAM_HEAD = 1 << 22
STREAM_BYTES = 500_000
#: Different keys that a task counts before it deals them.
STREAM_FLUSH = 2_000_000
#: Ends the binary form of a key; no token and no text has this byte.
KEY_MARK = 0xFE


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "replace").translate(ASCII_LOWER).split(), ppm.END]


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c): every token of the corpus with its count in training texts."""
    def batch(counts, others):
        words = [*counts, *others]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([*counts.values(), *([0] * len(others))], pa.int64())], ["token", "c"])

    def run(batches):
        counts, others = Counter(), set()
        for b in batches:
            for out, text in zip(b.column("out").to_pylist(), b.column("text").to_pylist(), strict=True):
                (others if out else counts).update(tokens_of(text))
                if len(counts) + len(others) > FLUSH:
                    yield batch(counts, others.difference(counts))
                    counts, others = Counter(), set()
        if counts or others:
            yield batch(counts, others.difference(counts))

    found = docs.select(held_out(F.col("doc_id")).alias("out"), "text").mapInArrow(run, "token binary, c bigint")
    return found.groupBy("token").agg(F.sum("c").alias("c"))


def _orders(counted) -> pa.RecordBatch:
    """(k, code, n) of one array of codes and one of counts per order."""
    size = [len(values) for values, _ in counted]
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(size), dtype=np.int32), size)), pa.array(np.concatenate([values for values, _ in counted]).view(np.int64)),
                                       pa.array(np.concatenate([n for _, n in counted]))], ["k", "code", "n"])


def train(tokens: DataFrame) -> ppm.Trie:
    """The trie of the contexts under ``LOCAL`` bytes of the token table (token, c)."""
    def run(batches):
        for b in batches:
            words = b.column("token").to_pylist()
            if words:
                yield _orders(ppm.count(words, b.column("c").to_numpy().astype(np.float64), LOCAL - 1))

    return _short(tokens.where("c > 0").select("token", "c").mapInArrow(run, "k int, code bigint, n bigint"))


def _short(grams: DataFrame) -> ppm.Trie:
    """The trie of the orders under ``LOCAL`` of counts (k, code, n)."""
    grams = grams.groupBy("k", "code").agg(F.sum("n").alias("n")).toArrow()
    k, code, n = (grams.column(c).to_numpy() for c in ("k", "code", "n"))
    orders = []
    for order in range(LOCAL):
        c, m = code[k == order].view(np.uint64), n[k == order]
        by = np.argsort(c)
        orders.append((c[by], m[by]))
    return ppm.Trie(orders)


def _chunks(batches):
    """(code, depth, n, tid) of whole groups, which follow each other, some ``CHUNK`` rows at a time."""
    held, rows, most = [], 0, CHUNK
    for b in batches:
        held.append([b.column(x).to_numpy() for x in ("code", "packed", "tid")])
        rows += b.num_rows
        if rows >= most:
            code, packed, tid = map(np.concatenate, zip(*held, strict=True))
            group = ppm.suffix(code.view(np.uint64), LOCAL)
            cut = int(np.flatnonzero(group != group[-1])[-1]) + 1 if group[0] != group[-1] else 0
            if cut:
                yield code[:cut].view(np.uint64), packed[:cut] & 7, packed[:cut] >> 3, tid[:cut]
            held, rows = [[code[cut:], packed[cut:], tid[cut:]]], len(code) - cut
            most = max(CHUNK, 2 * rows)
    if rows:
        code, packed, tid = map(np.concatenate, zip(*held, strict=True))
        yield code.view(np.uint64), packed & 7, packed >> 3, tid


def scored_tokens(tokens: DataFrame, trie: ppm.Trie) -> DataFrame:
    """(token, c, logp) of the token table (tid, token, c); ``trie``: see ``train``."""
    arrays = tokens.sparkSession.sparkContext.broadcast(vars(trie))     # plain arrays: the class travels with the task

    def model():
        out = ppm.Trie.__new__(ppm.Trie)
        out.__dict__.update(arrays.value)
        return out

    def near(batches):
        short = model()
        for b in batches:
            words = b.column("token").to_pylist()
            if words:
                yield pa.RecordBatch.from_arrays([b.column("tid"), b.column("token"), b.column("c"), pa.array(short.score(words, LOCAL))], ["tid", "token", "c", "near"])

    def far(batches):
        for b in batches:
            words = b.column("token").to_pylist()
            if words:
                code, owner, depth = ppm.positions(words)
                on = depth >= LOCAL
                code, owner, depth = code[on], owner[on], depth[on]
                packed = b.column("c").to_numpy()[owner] << 3 | depth
                yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(packed), pa.array(b.column("tid").to_numpy()[owner])], ["code", "packed", "tid"])

    def coded(batches):
        short = model()
        for code, depth, n, tid in _chunks(batches):
            (code, depth), at = ppm.Trie._distinct(code, depth)
            depth = depth.astype(np.int64)
            n = np.bincount(at, n, len(code)).astype(np.int64)
            logp = short.extended(ppm.longer(code, depth, n, LOCAL))._codes(code, depth)
            yield pa.RecordBatch.from_arrays([pa.array(tid), pa.array(logp[at])], ["tid", "logp"])

    group = F.shiftright("code", 8).bitwiseAND(F.lit((1 << (8 * LOCAL)) - 1))
    rows = tokens.mapInArrow(far, "code bigint, packed bigint, tid bigint").withColumn("g", group.cast("int"))
    sums = (rows.repartition("g").sortWithinPartitions("g").drop("g").mapInArrow(coded, "tid bigint, logp double")
            .groupBy(F.col("tid").alias("far_tid")).agg(F.sum("logp").alias("far")))
    own = tokens.mapInArrow(near, "tid bigint, token binary, c bigint, near double")
    return own.join(sums, F.col("tid") == F.col("far_tid"), "left").select("token", "c", (F.col("near") + F.coalesce("far", F.lit(0.0))).alias("logp"))


def _slices(texts: list[str | None]):
    """Ranges of texts with about ``STREAM_BYTES`` in each, as (first, one behind, their tokens)."""
    first, held, tokens = 0, 0, []
    for k, text in enumerate(texts):
        tokens.append(tokens_of(text))
        held += len(text or "")
        if held >= STREAM_BYTES or k + 1 == len(texts):
            yield first, k + 1, tokens
            first, held, tokens = k + 1, 0, []


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts."""
    by = np.argsort(keys, kind="stable")        # of a few sorted runs: merges them
    keys, n = keys[by], n[by]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def _joined(keys: np.ndarray, n: np.ndarray, more: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two tables of distinct keys in order and their counts as one; ``n`` is changed."""
    at = np.searchsorted(keys, more)
    there = at < len(keys)
    there[there] = keys[at[there]] == more[there]
    n[at[there]] += often[there]
    return np.insert(keys, at[~there], more[~there]), np.insert(n, at[~there], often[~there])


def key_counts(docs: DataFrame) -> DataFrame:
    """(part, keys, n): every key of whole texts with its count in training texts, packed by part."""
    parts = max(64, 8 * docs.rdd.getNumPartitions())

    def dealt(keys, n):
        part = (((ppm.suffix(keys, LOCAL) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.int64)
        by = np.argsort(part, kind="stable")
        part, keys, n = part[by].astype(np.int64), keys[by], n[by]
        cut = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
        return pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]]), pa.array([ppm.planes(keys[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
                                           pa.array([ppm.planes(n[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary())], ["part", "keys", "n"])

    def run(batches):
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            out = b.column("out").to_numpy(zero_copy_only=False)
            for lo, hi, texts in _slices(b.column("text").to_pylist()):
                found, sizes = ppm.keys([ppm.stream(ts) for ts in texts])
                for mine, one in ((~out[lo:hi], 1), (out[lo:hi], 0)):
                    some = np.sort(found[np.repeat(mine, sizes)])
                    at = np.flatnonzero(np.r_[True, some[1:] != some[:-1]]) if len(some) else np.zeros(0, np.int64)
                    keys, n = _joined(keys, n, some[at], one * np.diff(np.r_[at, len(some)]))
                if len(keys) > STREAM_FLUSH:
                    yield dealt(keys, n)
                    keys, n = keys[:0].copy(), n[:0].copy()
        if len(keys):
            yield dealt(keys, n)

    def merged(rows: pa.Table) -> pa.Table:
        keys, n = _summed(*(np.concatenate([ppm.unplaned(x) for x in rows.column(c).to_pylist()]) for c in ("keys", "n")))
        return pa.table({"part": rows.column("part").slice(0, 1), "keys": pa.array([ppm.planes(keys)], pa.binary()), "n": pa.array([ppm.planes(n.view(np.int64))], pa.binary())})

    schema = "part bigint, keys binary, n binary"
    found = docs.select(held_out(F.col("doc_id")).alias("out"), "text").mapInArrow(run, schema)
    return found.groupBy("part").applyInArrow(merged, schema)


def _unpacked(batches):
    """(code, depth, n) and the keys of whole parts."""
    for b in batches:
        for keys, n in zip(b.column("keys").to_pylist(), b.column("n").to_pylist(), strict=True):
            keys = ppm.unplaned(keys)
            yield *ppm.opened(keys), ppm.unplaned(n).view(np.int64), keys


def scored_keys(counts: DataFrame) -> DataFrame:
    """(keys, n, logp) of the key counts (part, keys, n), packed; code lengths in single precision."""
    def low(batches):
        for code, depth, n, _ in _unpacked(batches):
            yield _orders(ppm.longer(code, depth, n, 0, LOCAL - 1))

    arrays = counts.sparkSession.sparkContext.broadcast(vars(_short(counts.mapInArrow(low, "k int, code bigint, n bigint"))))

    def coded(batches):
        short = ppm.Trie.__new__(ppm.Trie)
        short.__dict__.update(arrays.value)
        for code, depth, n, keys in _unpacked(batches):
            logp = short.extended(ppm.longer(code, depth, n, LOCAL))._codes(code, depth)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (ppm.planes(keys), ppm.planes(n), logp.astype(np.float32).tobytes())], ["keys", "n", "logp"])

    return counts.mapInArrow(coded, "keys binary, n binary, logp binary")


def _scored(batches):
    """(keys, n, logp) of whole parts."""
    for b in batches:
        for keys, n, logp in zip(*(b.column(c).to_pylist() for c in ("keys", "n", "logp")), strict=True):
            yield ppm.unplaned(keys), ppm.unplaned(n).view(np.int64), np.frombuffer(logp, np.float32)


def _binary(keys: np.ndarray) -> pa.Array:
    """Keys as binary values that equal no token."""
    data = np.full((len(keys), 9), KEY_MARK, np.uint8)
    data[:, :8] = keys.astype("<u8").view(np.uint8).reshape(-1, 8)
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(np.arange(0, 9 * len(keys) + 1, 9, dtype=np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _head_of(scored: DataFrame) -> tuple[tuple[bytes, bytes], int]:
    """The most frequent keys, at most ``STREAM_HEAD``, in order and compressed, and their code lengths; the
    count from which on a key is one of them."""
    most = 1 << 12

    def sizes(batches):
        for _, n, _ in _scored(batches):
            e, k = np.unique(np.minimum(n, most), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(e), pa.array(k)], ["e", "k"])

    found = {r["e"]: r["k"] for r in scored.mapInArrow(sizes, "e bigint, k bigint").where("e > 0").groupBy("e").agg(F.sum("k").alias("k")).collect()}
    low, room = most + 1, STREAM_HEAD
    while low > 1 and found.get(low - 1, 0) <= room:
        low -= 1
        room -= found.get(low, 0)

    def heads(batches):
        for keys, n, logp in _scored(batches):
            yield pa.RecordBatch.from_arrays([pa.array([x[n >= low].tobytes()], pa.binary()) for x in (keys, logp)], ["keys", "logp"])

    # arrays travel packed: as rows they would fill the driver
    top = scored.mapInArrow(heads, "keys binary, logp binary").toArrow()
    keys, logp = (np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in top.column(c))]) for c, kind in (("keys", np.uint64), ("logp", np.float32)))
    by = np.argsort(keys)
    return (zlib.compress(ppm.planes(keys[by]), 1), logp[by].tobytes()), low


def _opened(head: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of a head, their slots and code lengths, the last entry for all others."""
    keys = ppm.unplaned(zlib.decompress(head[0]))
    return np.append(keys, np.uint64(0xFFFFFFFFFFFFFFFF)), ppm.slots_of(keys), np.append(np.frombuffer(head[1], np.float32), np.float32(0))


class _Index(dict):
    def __missing__(self, word):
        return -1


def scores(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (contexts end at the blank before a word), stream_score (they run over blanks)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    folder = scratch(spark, "key-counts")
    with shuffles_dropped(spark):
        packed = stored(key_counts(docs), "counts", folder)
    keys = stored(scored_keys(packed), "key-scores")
    discard(spark, folder)
    frequent, below = _head_of(keys)
    streams = spark.sparkContext.broadcast(frequent)

    def others(batches):
        for found, n, logp in _scored(batches):
            some = n < below
            yield pa.RecordBatch.from_arrays([_binary(found[some]), pa.array(np.zeros(some.sum(), np.int64)), pa.array(logp[some].astype(np.float64))], ["token", "c", "logp"])

    with shuffles_dropped(spark):
        folder = scratch(spark, "token-counts")
        counts = stored(token_counts(docs).select(F.monotonically_increasing_id().alias("tid"), "token", "c"), "counts", folder)
        total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
        tokens = stored(scored_tokens(counts, train(counts)), "token-scores")
    discard(spark, folder)
    log_all = math.log10(total + 0.1 * (kinds + 1))
    base = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1)) - F.lit(log_all)

    # the largest power of two classes of counts that fit into HEAD tokens
    sizes = {r["e"]: r["n"] for r in tokens.where("c > 0").groupBy(F.floor(F.log2("c")).alias("e")).agg(F.count("*").alias("n")).collect()}
    low, room = max(sizes, default=0) + 1, HEAD
    while low - 1 in range(0, max(sizes, default=-1) + 1) and sizes.get(low - 1, 0) <= room:
        low -= 1
        room -= sizes.get(low, 0)
    top = tokens.where(F.col("c") >= 2 ** low).toArrow()
    c = top.column("c").to_numpy()
    head = spark.sparkContext.broadcast((
        top.column("token").to_pylist(),
        np.append(np.log10(c + 0.1) - log_all, 0.0), np.append(top.column("logp").to_numpy(), 0.0)))

    def streamed(texts, known, slots, logp):
        """The code lengths of the texts' keys in the head, and the other keys as (text, key, count)."""
        keys, sizes = ppm.keys([ppm.stream(ts) for ts in texts])
        at = ppm.found(known, slots, keys)
        each = logp[at].astype(np.float64)
        rest = np.flatnonzero(at < 0)
        owner, rest = np.searchsorted(np.cumsum(sizes), rest, "right"), keys[rest]
        order = np.lexsort((rest, owner))
        owner, rest = owner[order], rest[order]
        new = np.flatnonzero(np.r_[True, (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1])]) if len(rest) else np.zeros(0, np.int64)
        return np.add.reduceat(each, np.cumsum(sizes) - sizes), owner[new], rest[new], np.diff(np.r_[new, len(rest)])

    def run(batches):
        words, base_of, logp_of = head.value
        opened = _opened(streams.value)
        index = _Index(zip(words, range(len(words)), strict=True))
        for b in batches:
            for lo, hi, texts in _slices(b.column("text").to_pylist()):
                ids, ties = (b.column(x).slice(lo, hi - lo) for x in ("doc_id", "tie"))
                stream, owner, rest, often = streamed(texts, *opened)
                sums, tail = [], []
                for k, ts in enumerate(texts):
                    at = np.fromiter(map(index.__getitem__, ts), np.int64, len(ts))
                    sums.append((len(ts), int((at >= 0).sum()), float(base_of[at].sum()), float(logp_of[at].sum())))
                    if (at < 0).any():
                        tail += [(k, t, n) for t, n in Counter(ts[i] for i in np.flatnonzero(at < 0).tolist()).items()]
                n, known, x, y = zip(*sums, strict=True)
                yield pa.RecordBatch.from_arrays([ids, ties, pa.array([b"\xff"] * len(n), pa.binary()), pa.array(n, pa.int64()), pa.nulls(len(n), pa.int64()),
                                                  pa.array(known, pa.int64()), *(pa.array(v, pa.float64()) for v in (x, y, stream))], names)
                for at, word, n, m in ([*(zip(*tail, strict=True) if tail else ((), (), ())), None], [owner, _binary(rest), None, often]):
                    if len(at):
                        none, at = np.zeros(len(at), np.int64), pa.array(at, pa.int64())
                        yield pa.RecordBatch.from_arrays([ids.take(at), ties.take(at), word if n is None else pa.array(word, pa.binary()), pa.array(none if n is None else n, pa.int64()),
                                                          pa.array(none if m is None else m, pa.int64()), *(pa.nulls(len(none), v) for v in (pa.int64(), *[pa.float64()] * 3))], names)

    names = ["doc_id", "tie", "word", "n", "often", "known", "head_base", "head_logp", "head_stream"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text").mapInArrow(
        run, "doc_id bigint, tie bigint, word binary, n bigint, often bigint, known bigint, head_base double, head_logp double, head_stream double")
    # rows of whole documents meet no token; their own key spreads them
    whole = F.col("head_base").isNotNull()
    rows = rows.withColumn("word", F.when(whole, F.concat("word", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))).otherwise(F.col("word")))
    # a key counts for the streams alone: it is no token
    both = tokens.select("token", "c", "logp").unionByName(keys.mapInArrow(others, "token binary, c bigint, logp double"))
    joined = rows.join(both, F.col("word") == F.col("token"), "left")
    part = joined.select(
        "doc_id", "tie", whole.cast("int").alias("copies"), F.when(whole, F.col("n")).otherwise(0).alias("n_tokens"),
        F.when(whole, F.col("known")).otherwise(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.when(whole, F.col("head_base")).otherwise(F.col("n") * base).alias("base_score"),
        F.when(whole, F.col("head_logp")).otherwise(F.col("n") * F.col("logp")).alias("score"),
        F.when(whole, F.col("head_stream")).otherwise(F.col("often") * F.col("logp")).alias("stream_score"))
    sums = part.groupBy("doc_id", "tie").agg(*(F.sum(x).alias(x) for x in ("copies", "n_tokens", "n_known", "base_score", "score", "stream_score")))
    # equal rows were summed together and come apart again
    return (sums.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                    *((F.col(x) / F.col("copies")).cast("long").alias(x) for x in ("n_tokens", "n_known")),
                    F.lit(total).cast("long").alias("train_tokens"),
                    *((F.col(x) / F.col("copies")).alias(x) for x in ("base_score", "score", "stream_score"))))


def op3_lm_scores(spark, sf_dir):
    return scores(table(spark, sf_dir, "documents"))
