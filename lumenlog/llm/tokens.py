"""Token-ID output: frequency-ranked ids in byte-aligned variable-length coding.

1. Texts are encoded word by word (``Encoder``) to a stored table of raw ids.
2. Id counts over all documents give ranks; the most frequent id has rank 0.
   The vocabulary bounds the counts, so they are the one thing collected.
3. Documents are range-partitioned by doc_id and sorted.  A document's ranks become
   1 to 4 bytes each; the lengths go to separate control bytes, two bits per id and
   four ids per byte.  Both streams are byte-aligned per document and packed into
   shards.
4. ``read_tokens`` decodes shards by a table lookup: a control byte gives four
   lengths, running sums give the offsets, masked gathers give the ranks.

File format, below one folder: ``ranks/`` (rank, token_id) and ``shards/`` with
one row per shard: part, seq (order), doc_ids, n_tokens, control, data.  Both
are Parquet files written by Spark's committer, so a lost executor leaves no
partial shard, on any storage that Spark can write.

Defined results: a null or empty text is the end id alone; null doc_ids sort
first; rows that repeat a doc_id are separate documents next to each other,
ordered by text hash; an empty table gives no shards; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, table

END_ID = 2
#: Ids of one shard at most, unless a single document has more.
SHARD_IDS = 1 << 20
#: Entries of one cache generation.
CACHE = 600_000
_TAIL = b".,!?;:%&*#$"
#: Below it lower-casing a letter is the same anywhere and stays one letter (but for U+0130).
_LATIN = "\u0250"


#: Lead bytes of the marks that compose with letters: j and a caron are one letter, J and a caron two.
_MARKS = (b"\xcc", b"\xcd")
#: Bytes by kind: a letter or digit, white space, full stop or comma, anything else.
_KINDS = bytes(x if x in b" .,\t\n\v\f\r" else 97 if chr(x).isalnum() and x < 128 else 112 for x in range(256))
_RUNS = tuple(a + b for a in (b"p", b".", b",") for b in (b".", b","))
_AFTER_LETTER = re.compile(rb"(?<=[a-z])([.,])(?=[ \t-\r])")


def parted(raw: bytes, added: tuple = ()) -> bytes:
    """``raw`` with a-z for A-Z and blanks before the full stops and commas that end a word: the
    same pieces to the splitter, which joins only punctuation to punctuation.  Texts with one of the tokens ``added`` to the vocabulary
    (lower-cased here), which count letter by letter as they are written, stay unchanged."""
    low = raw.lower()
    if any(m in raw for m in _MARKS) or any(a in low for a in added):
        return raw
    raw = low
    kinds = raw.translate(_KINDS)
    if any(r in kinds for r in _RUNS):
        return _AFTER_LETTER.sub(rb" \1", raw)
    return raw.replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n")


class Encoder:
    """Texts to the bytes of their ids.

    A tokenizer of another layout than ``LAYOUT`` encodes whole texts.  Of that layout, the tokenizer drops white space and no token spans it, so a text's ids are
    its words' ids, and words repeat: they are kept in two generations, of which the
    older goes when the younger is full.  A word of letters with punctuation after it
    is its lower-case stem's ids and the punctuation's, as the splitter parts letters
    from punctuation and the normaliser lower-cases; ``parted`` does both for most
    words of a text at once, so fewer different words are looked up.  New stems are
    encoded many at a time: a stem is one piece to the splitter, and a piece's last
    token is marked as such in the vocabulary."""

    #: The layout that allows encoding word by word (fixed values of the file format).
    LAYOUT = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+", "</w>")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = self._layout() == self.LAYOUT
        # stems are normal already and hold letters only: neither the normaliser nor the splitter changes them
        self.stems = Tokenizer.from_file(path)
        if self.by_words:
            self.stems.normalizer = normalizers.Sequence([])
            self.stems.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.dtype = "<u2" if max(vocab.values()) < 1 << 16 else "<u4"
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.added = tuple(t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.words: dict = {}
        self.old_words: dict = {}

    def _layout(self) -> tuple:
        d = json.loads(self.tokenizer.to_str())
        normal, pre = ((d[k] or {}) for k in ("normalizer", "pre_tokenizer"))
        pre = pre.get("pretokenizers", [])
        return ([x["type"] for x in normal.get("normalizers", [])], [x["type"] for x in pre],
                pre[0].get("pattern", {}).get("Regex") if pre else None, d["model"].get("end_of_word_suffix"))

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _encode_stems(self, stems: list[bytes]) -> dict:
        """The ids of ``stems``."""
        found: dict = {}
        parts = [stems[k:k + 200] for k in range(0, len(stems), 200)]
        size = np.dtype(self.dtype).itemsize
        for part, e in zip(parts, self.stems.encode_batch_fast([b" ".join(p).decode() for p in parts], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.dtype)
            ends = ((np.flatnonzero(self.last[ids]) + 1) * size).tolist()
            raw = ids.tobytes()
            if len(ends) == len(part):
                found.update(zip(part, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=True))
            else:       # a vocabulary without marked ends
                found.update((s, self._ids(s.decode())) for s in part)
        return found

    def _learn(self, words: set[bytes]) -> dict:
        """The ids of ``words``, which are kept."""
        old = self.old_words
        found = {w: old[w] for w in words if w in old}
        new = words.difference(found)
        wanted = {w for w in new if w.isalpha() and w.islower()}        # ASCII letters only: stems themselves
        split = []
        for w in new.difference(wanted):
            stem = w.rstrip(_TAIL)
            if stem.isalpha():
                key = stem.lower()
            elif stem.isascii():
                found[w] = self._ids(w.decode())
                continue
            else:
                text = stem.decode("utf-8", "replace")
                if not text.isalpha() or max(text) >= _LATIN or "\u0130" in text:
                    found[w] = self._ids(w.decode("utf-8", "replace"))
                    continue
                key = text.lower().encode()
            split.append((w, key, len(stem)))
        words = self.words
        stems = {key: words.get(key) or old.get(key) or found.get(key) for _, key, _ in split}       # no stem is without ids
        wanted.update(key for key, ids in stems.items() if not ids)
        found.update(self._encode_stems(list(wanted)))
        tails: dict = {b"": b""}
        for w, key, n in split:
            tail = w[n:]
            if tail not in tails:
                tails[tail] = self._ids(tail.decode())
            found[w] = (stems[key] or found[key]) + tails[tail]
        if len(self.words) + len(found) > CACHE:
            self.old_words, self.words = self.words, {}
        self.words.update(found)
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The bytes of every text's ids, some hundred thousand words at a time."""
        if not self.by_words:
            return [self._ids(t or "") for t in texts]
        out, words, ends = [], [], []
        for text in texts:
            words += parted((text or "").encode("utf-8", "replace"), self.added).split()
            ends.append(len(words))
            if len(words) > 100_000:
                out += self._encode_words(words, ends)
                words, ends = [], []
        return out + self._encode_words(words, ends)

    def _encode_words(self, words: list[bytes], ends: list[int]) -> list[bytes]:
        ids = list(map(self.words.get, words))
        missing = [k for k, x in enumerate(ids) if x is None]
        if missing:
            found = self._learn({words[k] for k in missing})
            for k in missing:
                ids[k] = found[words[k]]
        return [b"".join(ids[s:e]) for s, e in zip([0, *ends], ends, strict=False)]

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_all([text])[0], self.dtype)


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: Spark reuses its workers, so a later
    task finds the words of the earlier ones."""
    import sys
    import types
    held = sys.modules.setdefault("worker_encoders", types.ModuleType("worker_encoders"))
    if not hasattr(held, "by_path"):
        held.by_path = {}
    if path not in held.by_path:
        held.by_path.clear()
        held.by_path[path] = Encoder(path)
    return held.by_path[path]


#: Byte lengths (1 to 4) of the four ids of each control byte.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.int64)


def pack(ranks: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of consecutive documents with ``counts`` ranks each; every
    document starts a control byte of its own."""
    most = int(ranks.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    r = np.ascontiguousarray(ranks, f"<u{width}")
    size = np.zeros(len(r), np.uint8)       # bytes less one
    for bits in (8, 16, 24)[: width - 1]:
        size += r > (1 << bits) - 1
    slots = -(-counts // 4) * 4
    shift = np.cumsum(slots - counts) - (slots - counts)
    codes = np.zeros(int(slots.sum()), np.uint8)
    codes[np.arange(len(r)) + np.repeat(shift, counts)] = size
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | (codes[:, 1] << 2) | (codes[:, 2] << 4) | (codes[:, 3] << 6)
    return control.tobytes(), r.view(np.uint8).reshape(-1, width)[np.arange(width) <= size[:, None]].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranks of consecutive documents with ``counts`` ids each."""
    size = LENGTHS[control].ravel()
    slots = -(-counts // 4) * 4
    first = np.cumsum(slots) - slots
    real = np.arange(len(size)) - np.repeat(first, slots) < np.repeat(counts, slots)
    size = size[real]
    at = np.cumsum(size) - size
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = size > k
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, tie, ids): little-endian unsigned ids of every text, end id last."""
    def run(batches):
        enc = worker_encoder(tokenizer_path)
        width = int(enc.dtype[2]) if end_id < 1 << 16 else 4
        end = np.array([end_id], f"<u{width}").tobytes()
        for b in batches:
            ids = enc.encode_all(b.column("text").to_pylist())
            if width != int(enc.dtype[2]):
                ids = [np.frombuffer(x, enc.dtype).astype("<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tie"), pa.array([width] * len(ids), pa.int32()), pa.array([x + end for x in ids], pa.binary())],
                                             ["doc_id", "tie", "width", "ids"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, tie bigint, width int, ids binary")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    spark = docs.sparkSession
    from tokenizers import Tokenizer
    vocab = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1)
    raw_path = scratch(spark, "token-raw")
    encoded(docs, tokenizer_path, end_id).write.option("compression", "zstd").parquet(raw_path)
    raw = spark.read.parquet(raw_path)

    def count(batches):
        total = np.zeros(vocab, np.int64)
        for b in batches:
            if b.num_rows:      # one width in all rows
                w = b.column("width")[0].as_py()
                total += np.bincount(np.frombuffer(b"".join(b.column("ids").to_pylist()), f"<u{w}"), minlength=vocab)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids], pa.int64())], ["token_id", "n"])

    counts = raw.select("width", "ids").mapInArrow(count, "token_id int, n bigint").groupBy("token_id").agg(F.sum("n").alias("n")).collect()
    order = sorted(((-r["n"], r["token_id"]) for r in counts))
    spark.createDataFrame([(k, t, -n) for k, (n, t) in enumerate(order)], "rank int, token_id int, n bigint").coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(vocab, np.uint32)
    rank[[t for _, t in order]] = np.arange(len(order), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank)      # vocabulary size x 4 bytes

    id_type = dict(docs.dtypes)["doc_id"]
    ordered = raw.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "tie")

    def shards(batches):
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        ids, n, raw_ids, held = [], [], [], 0

        def flush():
            counts = np.array(n, np.int64)
            control, data = pack(ranks.value[np.frombuffer(b"".join(raw_ids), f"<u{w}")], counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([ids], pa.list_(id_kind)), pa.array([n], pa.list_(pa.int64())),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                ["part", "seq", "doc_ids", "n_tokens", "control", "data"])

        for b in batches:
            id_kind = b.column("doc_id").type
            for d, w, x in zip(*(b.column(name).to_pylist() for name in ("doc_id", "width", "ids")), strict=True):
                k = len(x) // w
                if ids and held + k > SHARD_IDS:
                    yield flush()
                    seq += 1
                    ids, n, raw_ids, held = [], [], [], 0
                held += k
                ids.append(d)
                n.append(k)
                raw_ids.append(x)
        if ids:
            yield flush()

    ordered.drop("tie").mapInArrow(shards, f"part int, seq int, doc_ids array<{id_type}>, n_tokens array<bigint>, control binary, data binary").write.parquet(f"{path}/shards")


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, with
    ``ids`` also the ids themselves."""
    table_ = spark.read.parquet(f"{path}/ranks").select("rank", "token_id").collect()     # at most the vocabulary
    token = np.zeros(max((r["rank"] for r in table_), default=-1) + 1, np.uint32)
    for r in table_:
        token[r["rank"]] = r["token_id"]
    tokens = spark.sparkContext.broadcast(token)
    shards = spark.read.parquet(f"{path}/shards")
    sizes = shards.select("part", "seq", F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))        # one row per file
    parts = parts.select(F.col("part").alias("__part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    offsets = (sizes.withColumn("inside", F.sum("n").over(Window.partitionBy("part").orderBy("seq")) - F.col("n"))
               .join(parts, F.col("part") == F.col("__part"))
               .select(F.col("part").alias("__part"), F.col("seq").alias("__seq"), (F.col("before") + F.col("inside")).alias("offset")))
    id_type = dict(shards.dtypes)["doc_ids"][len("array<"):-1]

    def decode(batches):
        for b in batches:
            for row in range(b.num_rows):
                docs = b.column("doc_ids")[row].values
                n = np.array(b.column("n_tokens")[row].values, np.int64)
                out = tokens.value[unpack(np.frombuffer(b.column("control")[row].as_buffer(), np.uint8),
                                          np.frombuffer(b.column("data")[row].as_buffer(), np.uint8), n)].astype("<u4")
                end = np.cumsum(n)
                raw = [out[e - k:e].tobytes() for e, k in zip(end.tolist(), n.tolist(), strict=True)]
                whole = [pa.array(raw, pa.binary())] if ids else []
                yield pa.RecordBatch.from_arrays(
                    [b.column("part").take(pa.array([row] * len(n))), b.column("seq").take(pa.array([row] * len(n))), docs, pa.array(end - n, pa.int64()),
                     pa.array(n, pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64()), *whole],
                    ["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32", *(["ids"] if ids else [])])

    docs = shards.mapInArrow(decode, f"part int, seq int, doc_id {id_type}, before bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids)
    return (docs.join(offsets, (F.col("part") == F.col("__part")) & (F.col("seq") == F.col("__seq")))
            .select("doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else [])))


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op10_token_ids(spark, sf_dir):
    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return read_tokens(spark, path)
