"""Phrase mining: an FM-index per shard over word ids, counts summed across shards.

1. Tasks cut their rows into shards of one language and about ``SHARD_WORDS`` words.  A
   shard numbers its own words, sorts its positions by the next four words (no phrase
   is longer) and stores the Burrows-Wheeler transform: the word before each position
   in that order.  Its words and their counts are stored beside it.
2. A phrase is an interval of that order.  ``extend`` takes all intervals of d-1 words
   one word to the left at once: the position before each one is its rank among equal
   words (the last-to-first mapping), which carries an interval over into one
   sub-interval per word before it.  The interval of d words lies inside that of its first
   d-1 words, which gives the extension to the right: each one is known by its two
   phrases of d-1 words.
3. Per number of words the shards' counts are summed.  A shard deals its phrases by hash
   to parts, one packed row per part; a part has about ``PART_WORDS`` entries at any size
   of the input, as their number grows with it.  The part sums equal phrases, names
   those that reach the bar, and tells each shard which of the entries it sent they
   are.  Only these are extended: a phrase below the bar has no frequent extension.
4. Scores, containment and ranks are joins and aggregates over the frequent phrases.

A shard's state is bounded by its words and a part's by its entries, of which a phrase
has one per shard; no task sees a language whole and nothing is collected but the
number of words.  Shards and sums are stored tables, so a lost executor's work is
done again from them.

Defined results: null or empty texts have no words; a null language is ``und``; rows
that repeat count each for itself; ids are not read; other columns, also of clashing
names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, stored, table

#: Words of one shard, unless one text has more, and words of the corpus per part.
SHARD_WORDS, PART_WORDS = 1 << 20, 1 << 20
DEPTH = 4
MIN_COUNT, CONTAINED, TOP = 30, 80, 2000
#: What ends a piece.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
#: No byte of UTF-8; stands for a piece's end.
END = b"\xff"
_MAP = bytes(END[0] if c in BREAKS else 0x20 if c == 0x09 else ASCII_LOWER[c] for c in range(256))


def numbered(texts: list[bytes], ids: dict[bytes, int]) -> np.ndarray:
    """The word numbers of ``texts``, piece ends as 0; ``ids`` learns new words."""
    raw = END.join(texts).translate(_MAP).replace(END, b" \xff ")
    out = np.fromiter(map(ids.__getitem__, raw.split()), np.int32)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)         # one end is enough
    return out[keep]


class _Ids(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def transform(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The word before each position, positions sorted by their next ``depth`` words."""
    n = len(text)
    rank, known = text.astype(np.int64), 1
    while known < depth:
        after = np.zeros(n, np.int64)
        step = min(known, depth - known)
        after[:n - step] = rank[step:] + 1
        _, rank = np.unique(rank * (n + 2) + after, return_inverse=True)
        known += step
    order = np.argsort(rank, kind="stable")
    return text[order - 1]          # before the first stands the last, a piece's end


class Index:
    """FM-index of one shard, whose text begins and ends with 0."""

    def __init__(self, before: np.ndarray):
        self.before = before
        order = np.argsort(before, kind="stable")
        self.first = before[order]                          # the word at each position
        self.to_first = np.empty(len(before), np.int64)     # last-to-first mapping
        self.to_first[order] = np.arange(len(before))

    def words(self, keep: np.ndarray) -> np.ndarray:
        """The kept word at each position, or -1."""
        return np.where(keep[self.first], self.first, -1)

    def extend(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``at`` has the number of the phrase that starts at each position, or -1.  The
        phrases one word longer, made of two of these: (number at each position, and
        per phrase the two it is made of, its count)."""
        from_ = np.flatnonzero(at >= 0)
        rest = np.full(len(at), -1, np.int64)       # the phrase behind a position's first word
        rest[self.to_first[from_]] = at[from_]
        here = np.flatnonzero((rest >= 0) & (at >= 0))
        new = np.ones(len(here), bool)
        a, b = at[here], rest[here]
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        number = np.cumsum(new) - 1
        out = np.full(len(at), -1, np.int64)
        out[here] = number
        return out, a[new], b[new], np.bincount(number, minlength=int(new.sum()))


def shards(docs: DataFrame, shard_words: int) -> DataFrame:
    """(shard, lang, before, n, words, counts, bytes): one row per shard, stored.  ``words`` are
    joined by line ends, which no word holds."""
    def run(batches):
        from pyspark import TaskContext
        part, made = TaskContext.get().partitionId(), 0
        held: dict = {}

        def new():
            return [np.zeros(1, np.int32)], _Ids({END: 0}), 0

        def flush(lang):
            nonlocal made
            chunks, ids, _ = held.pop(lang)
            text = np.concatenate([*chunks, np.zeros(1, np.int32)])
            counts = np.bincount(text, minlength=len(ids))
            made += 1
            joined = b"\n".join(list(ids)[1:])
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), pa.array([lang], pa.string()), pa.array([packed(transform(text))], pa.binary()),
                 pa.array([int(counts[1:].sum())], pa.int64()), pa.array([pa.compress(joined, "zstd", asbytes=True)], pa.binary()), pa.array([packed(counts[1:])], pa.binary()),
                 pa.array([len(joined)], pa.int64())],
                columns)

        columns = ["shard", "lang", "before", "n", "words", "counts", "bytes"]
        for b in batches:
            by_lang: dict = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                lo, size = 0, 0
                for k, t in enumerate(texts, 1):
                    size += len(t.as_buffer() or b"")
                    if size > 1 << 22 or k == len(texts):
                        chunks, ids, n = held.get(lang) or new()
                        chunks.append(numbered([END, *(t.as_py() or b"" for t in texts[lo:k])], ids))
                        held[lang] = chunks, ids, n + len(chunks[-1])
                        lo, size = k, 0
                        if held[lang][2] >= shard_words:
                            yield flush(lang)
        for lang in list(held):
            yield flush(lang)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return stored(rows.mapInArrow(run, "shard bigint, lang string, before binary, n bigint, words binary, counts binary, bytes bigint"), "phrase-shards")


def packed(x: np.ndarray) -> bytes:
    """Whole numbers; many of them compressed, their bytes by place as the high ones are mostly zero."""
    x = np.ascontiguousarray(x, "<i8")
    if len(x) < 64:
        return b"\0" + x.tobytes()
    return b"\1" + len(x).to_bytes(8, "little") + pa.compress(x.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    if raw[0] == 0:
        return np.frombuffer(raw, "<i8", offset=1)
    n = int.from_bytes(raw[1:9], "little")
    return np.frombuffer(pa.decompress(raw[9:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n).T.copy().view("<i8").ravel()


def part_of(head: np.ndarray, tail: np.ndarray, parts: int) -> np.ndarray:
    """The part to which a phrase of two phrases is dealt."""
    x = head.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tail.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(parts)).astype(np.int64)


def _dealt(shard: int, part: np.ndarray, parts: int, columns) -> pa.Table:
    """One row per part with the shard's entries, in their order."""
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    used = np.flatnonzero(np.diff(ends))
    rows = [[c(order[ends[p]:ends[p + 1]]) for p in used] for c in columns]
    return pa.table([pa.array(used, pa.int64()), pa.array([shard] * len(used), pa.int64()), *(pa.array(r, pa.binary()) for r in rows)],
                    names=["part", "shard", *(f"c{k}" for k in range(len(columns)))])


def _words_dealt(index: DataFrame, parts: int) -> DataFrame:
    """(part, shard, lang, c0, c1): the words of every shard and their counts."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                words = pa.decompress(r["words"], r["bytes"], "zstd", asbytes=True).split(b"\n") if r["n"] else []
                counts = unpacked(r["counts"])
                part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
                out = _dealt(r["shard"], part, parts, [lambda k, w=words: b"\n".join([w[i] for i in k]), lambda k, c=counts: packed(c[k])])
                yield from out.append_column("lang", pa.array([r["lang"]] * out.num_rows, pa.string())).to_batches()

    rows = index.select("shard", "lang", "n", "words", "counts", "bytes")
    return rows.mapInArrow(run, "part bigint, shard bigint, c0 binary, c1 binary, lang string")


_SUMMED = "part bigint, shard bigint, places binary, ids binary, phrases array<struct<id: bigint, lang: string, word: string, head: bigint, tail: bigint, f: bigint>>"


def _summed_table(part: int, back: list, phrases: pa.StructArray) -> pa.Table:
    """The rows of one part: those that tell a shard its frequent entries, and the phrases themselves."""
    n = len(back)
    lists = pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(phrases)], pa.int32()), phrases)
    shards_, places, ids = zip(*back) if back else ((), (), ())
    return pa.table([pa.array([part] * (n + 1), pa.int64()), pa.array([*shards_, None], pa.int64()), pa.array([*map(packed, places), None], pa.binary()),
                     pa.array([*map(packed, ids), None], pa.binary()), lists], names=["part", "shard", "places", "ids", "phrases"])


def _words_summed(dealt: DataFrame, parts: int, min_count: int) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        p = t.column("part")[0].as_py()
        rows = [(r["shard"], r["lang"], r["c0"].split(b"\n"), unpacked(r["c1"])) for r in t.to_pylist()]
        total: dict = {}
        for _, lang, words, counts in rows:
            mine = total.setdefault(lang, {})
            for w, n in zip(words, counts.tolist(), strict=True):
                mine[w] = mine.get(w, 0) + n
        named = [(lang, w, n) for lang in sorted(total) for w, n in sorted(total[lang].items()) if n >= min_count]
        name = {(lang, w): k * parts + p for k, (lang, w, _) in enumerate(named)}
        back = []
        for shard, lang, words, _ in rows:
            ids = np.array([name.get((lang, w), -1) for w in words], np.int64)
            back.append((shard, np.flatnonzero(ids >= 0), ids[ids >= 0]))
        none = pa.nulls(len(named), pa.int64())
        langs, words, counts = zip(*named) if named else ((), (), ())
        phrases = pa.StructArray.from_arrays([pa.array(np.arange(len(named)) * parts + p, pa.int64()), pa.array(langs, pa.string()), pa.array([w.decode() for w in words], pa.string()),
                                              none, none, pa.array(counts, pa.int64())], ["id", "lang", "word", "head", "tail", "f"])
        return _summed_table(p, back, phrases)

    return stored(dealt.groupBy("part").applyInArrow(run, _SUMMED), "phrases-summed")


def _phrases_summed(dealt: DataFrame, parts: int, min_count: int) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        p = t.column("part")[0].as_py()
        shard, sent = t.column("shard").to_pylist(), [unpacked(x.as_py()).reshape(3, -1) for x in t.column("c0")]
        ends = np.cumsum([x.shape[1] for x in sent])
        head, tail, n = np.concatenate(sent, axis=1)
        order = np.lexsort((tail, head))
        h, x = head[order], tail[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (x[1:] != x[:-1])
        first = np.flatnonzero(new)
        f = np.add.reduceat(n[order], first)
        often = f >= min_count
        group = np.empty(len(h), np.int64)
        group[order] = np.where(often, np.cumsum(often) - 1, -1)[np.cumsum(new) - 1]
        back = []
        for s, lo, hi in zip(shard, [0, *ends[:-1]], ends, strict=True):
            places = np.flatnonzero(group[lo:hi] >= 0)
            back.append((s, places, group[lo:hi][places] * parts + p))
        k = int(often.sum())
        none = pa.nulls(k, pa.string())
        phrases = pa.StructArray.from_arrays([pa.array(np.arange(k) * parts + p, pa.int64()), none, none, pa.array(h[first[often]], pa.int64()), pa.array(x[first[often]], pa.int64()),
                                              pa.array(f[often], pa.int64())], ["id", "lang", "word", "head", "tail", "f"])
        return _summed_table(p, back, phrases)

    return stored(dealt.groupBy("part").applyInArrow(run, _SUMMED), "phrases-summed")


def _extended(index: DataFrame, summed: list[DataFrame], parts: int) -> DataFrame:
    """(part, shard, c0): heads, tails and counts of the phrases of every shard that
    are made of two frequent ones.  ``summed`` has the sums of each length so far."""
    depth = len(summed) + 1
    back = None
    for k, x in enumerate(summed, 1):
        x = x.where(F.col("shard").isNotNull()).select("shard", F.lit(k).alias("length"), "part", "places", "ids")
        back = x if back is None else back.unionByName(x)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        told: dict = {}
        for r in right.to_pylist():
            told.setdefault(r["length"], {})[r["part"]] = unpacked(r["places"]), unpacked(r["ids"])

        def names(part: np.ndarray, length: int) -> np.ndarray:
            """The id of each entry the shard sent, -1 where it is not frequent."""
            order = np.argsort(part, kind="stable")
            first = np.searchsorted(part[order], np.arange(parts))
            out = np.full(len(part) + 1, -1, np.int64)         # the last for -1
            for p, (places, ids) in told.get(length, {}).items():
                out[order[first[p] + places]] = ids
            return out

        fm = Index(unpacked(row["before"]).astype(np.int32))
        words = pa.decompress(row["words"], row["bytes"], "zstd", asbytes=True).split(b"\n") if row["n"] else []
        known = names(np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words)), 1)
        known = np.concatenate([[-1], known])               # word 0 is a piece's end
        at = fm.words(known[:-1] >= 0)
        for k in range(2, depth + 1):
            at, head, tail, count = fm.extend(at)
            head, tail = known[head], known[tail]
            part = part_of(head, tail, parts)
            if k < depth:           # only those that are frequent everywhere go on
                known = names(part, k)
                at = np.where(known[at] >= 0, at, -1)
        return _dealt(row["shard"], part, parts, [lambda k: packed(np.concatenate([head[k], tail[k], count[k]]))])

    none = pa.table([pa.array([], pa.int64())] * 2 + [pa.array([], pa.binary())], names=["part", "shard", "c0"])
    return (index.select("shard", "before", "n", "words", "bytes").groupBy("shard").cogroup(back.groupBy("shard"))
            .applyInArrow(lambda a, b: run(a, b) if a.num_rows and b.num_rows else none, "part bigint, shard bigint, c0 binary"))


def counts(docs: DataFrame, depth: int = DEPTH, min_count: int = MIN_COUNT, shard_words: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) with the number of words, and for each length the phrases with at least
    ``min_count`` occurrences: (id, lang, phrase, last, f, starts, ends, head, tail).
    ``starts`` and ``ends`` are the counts of its first and last 1, 2, … words; ``head`` and
    ``tail`` the ids of the two phrases it is made of."""
    index = shards(docs, shard_words or SHARD_WORDS)
    totals = index.groupBy("lang").agg(F.sum("n").alias("n")).where(F.col("n") > 0)
    parts = 1 + (index.agg(F.sum("n")).first()[0] or 0) // PART_WORDS
    summed = [_words_summed(_words_dealt(index, parts), parts, min_count)]
    rows = summed[0].select(F.inline("phrases"))
    levels = [rows.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("starts"), F.array("f").alias("ends"), "head", "tail")]
    for _ in range(2, depth + 1):
        summed.append(_phrases_summed(_extended(index, summed, parts), parts, min_count))
        named = summed[-1].select(F.inline("phrases")).select("id", "head", "tail", "f")
        h = levels[-1].select(F.col("id").alias("head"), "lang", F.col("phrase").alias("start"), "starts")
        t = levels[-1].select(F.col("id").alias("tail"), "last", "ends")
        levels.append(stored(named.join(h, "head").join(t, "tail").select(
            "id", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "f",
            F.concat("starts", F.array("f")).alias("starts"), F.concat("ends", F.array("f")).alias("ends"), "head", "tail"), "phrases"))
    return totals, levels


def collocations(docs: DataFrame, depth: int = DEPTH, min_count: int = MIN_COUNT, contained: int = CONTAINED, top: int | None = TOP,
                 shard_words: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of every language's best phrases."""
    totals, levels = counts(docs, depth, min_count, shard_words)
    wide = lambda c: F.col(c).cast("decimal(20,0)")        # noqa: E731  products may pass 64 bits
    scored = []
    for k in range(2, depth + 1):
        cuts = F.array(*(F.struct(F.expr(f"(2000000BD * cast(f as decimal(20,0))) div (cast(starts[{c - 1}] as decimal(20,0)) + ends[{k - c - 1}])").alias("score"),
                                  F.lit(c).alias("cut"), F.col("starts")[c - 1].alias("l"), F.col("ends")[k - c - 1].alias("r")) for c in range(1, k)))
        rows = levels[k - 1].withColumn("best", F.array_min(cuts))
        if k < depth:
            # a longer phrase that holds this one holds it with one word more on a side, at least as often
            longer = levels[k].select(F.explode(F.array("head", "tail")).alias("held"), F.col("f").alias("m")).groupBy("held").agg(F.max("m").alias("m"))
            rows = rows.join(longer, rows["id"] == longer["held"], "left").where(F.col("m").isNull() | (wide("m") * 100 < wide("f") * contained))
        scored.append(rows.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", F.col("best.score").cast("bigint").alias("score")))
    out = scored[0]
    for x in scored[1:]:
        out = out.unionByName(x)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.withColumn("rank", F.row_number().over(order))
    if top is not None:
        out = out.where(F.col("rank") <= top)       # planned as a limit per task before the exchange
    total = totals.select(F.col("lang").alias("__lang"), "n")
    return out.join(total, F.col("lang") == F.col("__lang")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[.,;:!?\x0A-\x0D]')) AS s FROM documents),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k) GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS x FROM g WHERE k > 1 AND f >= 30),
cut AS (SELECT c.*, c.x[1:j] AS u, c.x[j + 1:] AS v, j FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c),
sc AS (SELECT cut.lang, cut.k, cut.phrase, cut.a, j, b.f AS l, e.f AS r, (2000000::HUGEINT * cut.a) // (b.f + e.f) AS score
       FROM cut JOIN g b ON b.lang = cut.lang AND b.phrase = array_to_string(u, ' ') JOIN g e ON e.lang = cut.lang AND e.phrase = array_to_string(v, ' ')),
best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
sub AS (SELECT lang, array_to_string(list_slice(x, i, i + m - 1), ' ') AS phrase, max(a) AS longer
        FROM (SELECT lang, k, a, x, m, unnest(range(1, k - m + 2)) AS i FROM cand, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN sub ON sub.lang = best.lang AND sub.phrase = best.phrase WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""
