"""Fill-in-middle transformation: cuts found on a wavelet matrix of classes.

Every byte of a text gets a class: continuation byte, white space, first byte of
a word, other byte of a word, the first and third also marked at a line's start.
A wavelet matrix over the classes of a block of texts answers how often a class
occurs before a byte (``rank``).  The units before a byte are a sum of ranks: code
points are all classes but one, words are two classes, lines are two.  A text's
number of units is the difference of two such counts, and a cut after k units is
where bisection on them finds the start of unit k + 1, for all texts of a block at
once.

Which units end the prefix and the middle, and which form a document takes, comes
from the sha256 of the seed and its id, so reruns and lost executors agree.

Defined results: a null text is empty; an empty text, one that holds a sentinel,
and the share ``1 - rate`` of the rest stay plain; rows that repeat are transformed
alike, each for itself; a null id hashes as the empty string; other columns, also
of clashing names, are ignored; an empty table gives no rows.  No text is cut off:
a text longer than a block is a block of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text under one wavelet matrix, unless one text has more.
BLOCK = 1 << 22
CONT, SPACE, LINE_SPACE, WORD, LINE_WORD, REST = range(6)
#: The classes at which a unit starts.
UNITS = {"chars": (SPACE, LINE_SPACE, WORD, LINE_WORD, REST), "words": (WORD, LINE_WORD), "lines": (LINE_SPACE, LINE_WORD)}


def classes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte of texts that begin at ``starts``; white space is ASCII."""
    kind = np.full(256, REST, np.uint8)
    kind[0x80:0xC0] = CONT
    kind[[0x20, *range(0x09, 0x0E)]] = SPACE
    out = kind[raw]
    begins = np.zeros(len(raw) + 1, bool)
    begins[starts] = True
    line = begins.copy()
    line[1:] |= raw == 0x0A
    after_space = begins
    after_space[1:] |= out == SPACE
    out[(out == REST) & after_space[:-1]] = WORD
    line = line[:-1]
    out[line & (out == SPACE)] = LINE_SPACE
    out[line & (out == WORD)] = LINE_WORD
    return out


class WaveletMatrix:
    """Ranks over a sequence of small numbers: one bit vector per binary digit, the
    sequence stably parted by each digit before the next."""

    def __init__(self, values: np.ndarray, bits: int = 3):
        self.n, self.bits, self.levels = len(values), bits, []
        for digit in reversed(range(bits)):
            bit = (values >> digit) & 1 == 1
            packed = np.zeros(self.n // 64 + 1, "<u8")
            packed.view(np.uint8)[: -(-self.n // 8)] = np.packbits(bit, bitorder="little")
            before = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=before[1:])
            self.levels.append((packed, before, self.n - int(before[-1])))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, value: int, at: np.ndarray) -> np.ndarray:
        """How often ``value`` occurs before each position of ``at``."""
        low, high = np.zeros_like(at), at
        for digit, (packed, before, zeros) in zip(reversed(range(self.bits)), self.levels, strict=True):
            if value >> digit & 1:
                low, high = (zeros + self._ones(packed, before, x) for x in (low, high))
            else:
                low, high = (x - self._ones(packed, before, x) for x in (low, high))
        return high - low

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & mask)


def units_before(matrix: WaveletMatrix, unit: str, at: np.ndarray) -> np.ndarray:
    """Unit starts before each byte: a sum of ranks, or what the other classes leave."""
    wanted = UNITS[unit]
    rest = [c for c in range(REST + 1) if c not in wanted]
    if len(rest) < len(wanted):
        return at - sum(matrix.rank(c, at) for c in rest)
    return sum(matrix.rank(c, at) for c in wanted)


def cut_after(matrix: WaveletMatrix, unit: str, start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Byte at which each text is cut after its first ``k`` units: 0 units end at its
    start, else the next unit's start, or the text's end."""
    target = units_before(matrix, unit, start) + k
    low, high = start.copy(), end.copy()        # the first byte whose following count passes the target
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        past = units_before(matrix, unit, np.minimum(mid + 1, matrix.n)) > target
        high = np.where(open_ & past, mid, high)
        low = np.where(open_ & ~past, mid + 1, low)
    return np.where(k == 0, start, low)


def cuts(texts: list[bytes], h1: np.ndarray, h2: np.ndarray, unit: str) -> tuple[np.ndarray, ...]:
    """(units, units to the first cut, to the second, first cut, second cut) of every
    text; cuts are byte offsets in the text."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    matrix = WaveletMatrix(classes(raw, starts))
    n = units_before(matrix, unit, ends) - units_before(matrix, unit, starts)
    a, b = h1 % (n + 1), h2 % (n + 1)
    first, second = np.minimum(a, b), np.maximum(a, b)
    at = cut_after(matrix, unit, np.tile(starts, 2), np.tile(ends, 2), np.concatenate([first, second])).reshape(2, -1) - starts
    return n, first, second, at[0], at[1]


def _number(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, unit: str = "chars", seed: int = 1, rate: int = 90, spm: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, output) of every document.  ``rate``
    per cent are cut, of those ``spm`` per cent with the suffix first."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {sorted(UNITS)}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    plain = (F.col("text") == "") | (_number(F.col("digest"), 2) % 100 >= rate)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        plain |= F.contains("text", F.lit(sentinel))
    form = F.when(plain, "plain").when(_number(F.col("digest"), 3) % 100 < spm, "spm").otherwise("psm")
    rows = rows.select("doc_id", form.alias("form"), _number(F.col("digest"), 0).alias("h1"), _number(F.col("digest"), 1).alias("h2"), F.col("text").cast("binary").alias("text"))
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def block(b: pa.RecordBatch, lo: int, texts: list[bytes]) -> pa.RecordBatch:
        b = b.slice(lo, len(texts))
        n, first, second, cut1, cut2 = cuts(texts, b.column("h1").to_numpy(), b.column("h2").to_numpy(), unit)
        forms = b.column("form").to_pylist()
        out = []
        for form, t, i, j in zip(forms, texts, cut1.tolist(), cut2.tolist(), strict=True):
            out.append(t if form == "plain" else b"".join((p, t[:i], s, t[j:], m, t[i:j]) if form == "psm" else (s, t[j:], p, t[:i], m, t[i:j])))
        plain = np.array([f == "plain" for f in forms], bool)
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int64()), b.column("form"), pa.array(first, pa.int64(), mask=plain), pa.array(second - first, pa.int64(), mask=plain), pa.array(out, pa.binary())],
            ["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    def run(batches):
        for b in batches:
            lo, texts, held = 0, [], 0
            for t in b.column("text"):
                t = t.as_py()
                if texts and held + len(t) > BLOCK:
                    yield block(b, lo, texts)
                    lo, texts, held = lo + len(texts), [], 0
                texts.append(t)
                held += len(t)
            if texts:
                yield block(b, lo, texts)

    id_type = dict(docs.dtypes)["doc_id"]
    out = rows.mapInArrow(run, f"doc_id {id_type}, n bigint, form string, prefix_units bigint, middle_units bigint, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restore(out: DataFrame) -> DataFrame:
    """``out`` of ``transform`` with the column ``text`` that it was made from, by the
    output and the form alone.  The text holds no sentinel and a sentinel overlaps no
    other, so the three that were put in are the only ones."""
    parts = F.split("output", f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    rows = out.select(*out.columns, F.when(F.col("form") != "plain", parts).alias("__parts"))
    p, s, m = (F.when(F.col("form") == "psm", F.col("__parts")[i]).otherwise(F.col("__parts")[j]) for i, j in ((1, 2), (2, 1), (3, 3)))
    return rows.select(*out.columns, F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat(p, m, s)).alias("text"))


def op12_fill_in_middle(spark, sf_dir):
    out = restore(transform(table(spark, sf_dir, "documents")))
    return out.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS r3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS r4 FROM d),
f AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r3 >= 90 THEN 'plain' WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
c AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""
