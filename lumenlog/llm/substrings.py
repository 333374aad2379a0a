"""Substring dedup by recompression.

A window is 13 consecutive words.  A word goes if a window that covers it has the
same words as a window that starts in a document with a smaller doc_id.

1. Every document is recompressed (``recompress``): rounds give equal runs and
   pairs equal names in all documents.  Each window is held by one symbol that it
   settles itself (its anchor), so equal windows have equal anchors, and a
   document has about one anchor for five words.
2. Spark looks for anchors that several documents share.  Per task, an anchor's
   documents are reduced first: all but the smallest are known to share it, so at
   most one row per anchor and batch meets in a group, however often it repeats.
3. Only the windows that shared anchors hold are named whole.  A window's identity
   is its own name (64 bits) and 32 bits of its anchor's.  The same reduction
   applies; a window is repeated if its smallest document is smaller than its own.
4. Documents with repeated windows lose the words that these cover.

Whole copies need no windows: a copy of a smaller document loses all its words if
it has a window at all, so copies leave after step 2.

Defined results: null, empty and word-less texts have 0 words; a null doc_id is
not ordered, so such rows neither lose words nor make others lose them; rows that
share a doc_id do not affect each other; an empty table gives no rows; other
columns are ignored (``deduplicated`` gives texts).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table
from .neardup import WordHashes
from .recompress import anchors, mix, window_names

WINDOW = 13
#: Words that are recompressed at once, and anchors that are reduced at once.
CHUNK_WORDS = 200_000
BATCH_ROWS = 500_000
TIE_BITS = 20
#: What is known of a row: nothing yet; other documents have it; a smaller one has it; no smaller one can have it.
OPEN, SHARED, SMALLER, GIVES = 0, 1, 2, 3


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def _anchored(hashed: list[np.ndarray], window: int):
    """(document index, start inside it, anchor, words, offsets) of every window
    of several documents, recompressed as one sequence with separators."""
    k = len(hashed)
    marks = mix(np.arange(k, dtype=np.uint64) + np.uint64(0xD6E8FEB86659FD93))
    size = np.array([len(x) + 1 for x in hashed])
    end = np.cumsum(size)
    words = np.empty(int(end[-1]), np.uint64)
    for x, e, s, m in zip(hashed, end.tolist(), size.tolist(), marks, strict=True):
        words[e - s:e - 1] = x
        words[e - 1] = m
    found = anchors(words, window)
    n = len(found)
    owner = np.repeat(np.arange(k), size)
    whole = np.arange(n) + window < np.repeat(end, size)[:n]
    at = np.flatnonzero(whole)
    return owner[at], at - (end - size)[owner[at]], found[at], words, at


def _chunks(batches, columns):
    """Rows of several batches in chunks of about CHUNK_WORDS words:
    (word hashes, the other columns' values, ...)."""
    hashes = WordHashes()
    rows, held = [], 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
            h = hashes.of(words_of(row[0]))
            rows.append((h, *row))
            held += len(h) + 1
            if held >= CHUNK_WORDS:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _first_of(*keys):
    """Marks, in sorted rows, the first of each run of equal keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def shared_anchors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, name, ask): anchors that several documents have; ``ask`` where a
    smaller document has it."""
    def reduce(names, ids):
        names, ids = np.concatenate(names), np.concatenate(ids)
        order = np.lexsort((ids, names))
        names, ids = names[order], ids[order]
        once = _first_of(names, ids)
        names, ids = names[once], ids[once]
        first = _first_of(names)
        many = np.r_[first[1:] == 0, False] if len(first) else first
        # decided rows are spread, so that a frequent anchor is one row per batch in its group
        key = np.where(first, names, mix(names + mix(ids.view(np.uint64))))
        state = np.where(first, np.where(many, SHARED, OPEN), SMALLER).astype(np.int8)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key.view(np.int64)), pa.array(names.view(np.int64), mask=first), pa.array(state)],
                                          ["doc_id", "key", "name", "state"])

    def run(batches):
        names, ids, held = [], [], 0
        for rows in _chunks(batches, ["text", "doc_id"]):
            if not rows:
                continue
            owner, _, found, _, _ = _anchored([r[0] for r in rows], window)
            new = _first_of(found, owner)
            names.append(found[new])
            ids.append(np.array([r[2] for r in rows], np.int64)[owner[new]])
            held += len(names[-1])
            if held >= BATCH_ROWS:
                yield reduce(names, ids)
                names, ids, held = [], [], 0
        if held:
            yield reduce(names, ids)

    found = docs.where("doc_id is not null").select("text", "doc_id").mapInArrow(run, "doc_id bigint, key bigint, name bigint, state tinyint")
    group = Window.partitionBy("key")
    return (found.withColumn("lo", F.min("doc_id").over(group)).withColumn("hi", F.max("doc_id").over(group))
            .where(f"state <> {OPEN} or lo < hi")
            .select("doc_id", F.coalesce("name", "key").alias("name"), ((F.col("state") == SMALLER) | (F.col("doc_id") > F.col("lo"))).alias("ask")))


def repeated_windows(wanted: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, at): windows that a smaller document has too.  ``wanted``: (doc_id,
    text, tie, asked, others) with the shared anchors' names; ``at`` is the start
    and the tie of the text."""
    def reduce(parts):
        h, name, ids, at, ask = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((ids, name, h))
        h, name, ids, at, ask = h[order], name[order], ids[order], at[order], ask[order]
        first = _first_of(h, name)
        sure = ids > ids[np.flatnonzero(first)][np.cumsum(first) - 1]
        key = np.where(sure, mix(ids.view(np.uint64) + mix(at.view(np.uint64))), h)
        state = np.where(sure, SMALLER, np.where(ask, OPEN, GIVES)).astype(np.int8)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(at), pa.array(key.view(np.int64)), pa.array((name >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(state)],
                                          ["doc_id", "at", "key", "name", "state"])

    def run(batches):
        parts, held = [], 0
        for rows in _chunks(batches, ["text", "doc_id", "tie", "asked", "others"]):
            owner, start, found, words, at = _anchored([r[0] for r in rows], window)
            cut = np.searchsorted(owner, np.arange(len(rows) + 1))
            whole = window_names(words, window)
            for k, (_, _, doc_id, tie, asked, others) in enumerate(rows):
                s, e = cut[k], cut[k + 1]
                mine = found[s:e]
                ask = np.isin(mine, np.array(asked, np.int64).view(np.uint64))
                on = np.flatnonzero(ask | np.isin(mine, np.array(others, np.int64).view(np.uint64)))
                if len(on):
                    parts.append((whole[at[s + on]], mine[on], np.full(len(on), doc_id, np.int64), (start[s + on] << TIE_BITS) | tie, ask[on]))
                    held += len(on)
            if held >= BATCH_ROWS:
                yield reduce(parts)
                parts, held = [], 0
        if held:
            yield reduce(parts)

    found = wanted.select("text", "doc_id", "tie", "asked", "others").mapInArrow(run, "doc_id bigint, at bigint, key bigint, name int, state tinyint")
    lowest = F.min("doc_id").over(Window.partitionBy("key", "name"))
    return found.withColumn("lo", lowest).where(f"state = {SMALLER} or (state = {OPEN} and lo < doc_id)").select("doc_id", "at")


def _kept(words: list[bytes], starts, window: int) -> list[bytes]:
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, np.asarray(starts) + window, -1)
    return [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]


def deduplicated(docs: DataFrame, window: int = WINDOW, texts: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256; with
    ``texts`` also the kept words joined by spaces."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tie = F.xxhash64("text").bitwiseAND(F.lit((1 << TIE_BITS) - 1))

    # whole copies of a smaller document
    digest = docs.where("doc_id is not null and text is not null").select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"))
    first = digest.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = digest.join(first, "sha").where("doc_id > first")

    shared = shared_anchors(docs, window)
    wanted = shared.groupBy("doc_id").agg(F.collect_list(F.when(F.col("ask"), F.col("name"))).alias("asked"),
                                          F.collect_list(F.when(~F.col("ask"), F.col("name"))).alias("others"))
    # rows that repeat a copy's id with another text are told apart by the digest
    alone = docs.select("doc_id", "text").where("doc_id is not null")
    copied = copies.select(F.col("doc_id").alias("__d"), F.col("sha").alias("__sha"))
    wanted = alone.join(wanted, "doc_id").select("doc_id", "text", "asked", "others", tie.alias("tie"))
    flat_copies = copied.groupBy("__d").agg(F.collect_set("__sha").alias("__shas"))
    wanted = (wanted.join(flat_copies, F.col("doc_id") == F.col("__d"), "left")
              .where(F.col("__shas").isNull() | ~F.array_contains("__shas", F.unhex(F.sha2("text", 256)))))
    marked = repeated_windows(wanted, window).groupBy("doc_id").agg(F.collect_list("at").alias("marks"))

    def cut(batches):
        for b in batches:
            out = []
            for doc_id, tie_, text, marks in zip(*(b.column(c).to_pylist() for c in ("doc_id", "tie", "text", "marks")), strict=True):
                m = np.array(marks, np.int64)
                starts = (m >> TIE_BITS)[(m & ((1 << TIE_BITS) - 1)) == tie_]
                if len(starts):
                    words = words_of(text)
                    kept = _kept(words, starts, window)
                    body = b" ".join(kept)
                    out.append((doc_id, tie_, len(words) - len(kept), hashlib.sha256(body).hexdigest(), body.decode() if texts else None))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                              pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())], ["d", "t", "removed", "sha", "cut"])

    again = docs.select("doc_id", "text").where("doc_id is not null")
    changed = (again.join(marked, "doc_id").select("doc_id", tie.alias("tie"), "text", "marks")
               .mapInArrow(cut, "d bigint, t bigint, removed bigint, sha string, cut string").dropDuplicates(["d", "t"]))

    def plain(batches):
        for b in batches:
            words = [words_of(t) for t in b.column("text").to_pylist()]
            whole = [b" ".join(w) for w in words]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tie"), b.column("digest"), pa.array([len(w) for w in words], pa.int64()),
                                              pa.array([hashlib.sha256(x).hexdigest() for x in whole], pa.string()),
                                              pa.array([x.decode() for x in whole] if texts else [None] * len(whole), pa.string())],
                                             ["doc_id", "tie", "digest", "n_words", "whole", "text"])

    base = docs.select("doc_id", tie.alias("tie"), F.unhex(F.sha2("text", 256)).alias("digest"), "text").mapInArrow(
        plain, "doc_id bigint, tie bigint, digest binary, n_words bigint, whole string, text string")
    copied = copied.distinct().withColumn("copy", F.lit(True))
    out = (base.join(changed, (F.col("doc_id") == F.col("d")) & (F.col("tie") == F.col("t")), "left")
           .join(copied, (F.col("doc_id") == F.col("__d")) & (F.col("digest") == F.col("__sha")), "left"))
    gone = F.coalesce(F.col("copy"), F.lit(False)) & (F.col("n_words") >= window)
    cols = [F.col("doc_id"), F.col("n_words"),
            F.when(gone, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256")]
    if texts:
        cols.append(F.when(gone, F.lit("")).otherwise(F.coalesce("cut", "text")).alias("text"))
    return out.select(*cols)


def op1_substring_dedup(spark, sf_dir):
    return deduplicated(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT g.doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN m ON g.s = m.s WHERE m.first < g.doc_id)),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT each.doc_id, string_agg(word, ' ' ORDER BY each.p) AS t, count(*) AS n FROM each ANTI JOIN gone ON each.doc_id = gone.doc_id AND each.p = gone.p GROUP BY each.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
