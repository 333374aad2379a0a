"""SentencePiece encoding and decoding by a table of every prefix's last token.

Byte-pair encoding gives each prefix of a text exactly one last token: the token t
that ends the prefix such that what stands before t, ending in its own last token p,
is not merged across the border of p and t.  Whether a pair (p, t) stays apart is a
property of the two tokens alone.  So the table is filled from the left: an automaton
over the vocabulary gives the tokens that end at a character, and the one whose pair
with the last token before it is compatible is stored.  The ids are recovered
backwards from the last prefix.  The work is linear in the text.

Compatibility replays the merges next to the border: the right edge of p and the
left edge of t grow in order of rank, and the pair is apart if no merge across the
border comes first.  Tokens whose edges do not grow in rank order, or whose rank is
shared (runs of blanks), are replayed on their joined characters instead.

A piece with a blank mark has it in front, so no token spans the border from another
character to a mark, nor a character outside the vocabulary; the parts between such
borders repeat and a worker keeps the ids of recent ones.

Models: BPE with byte fallback, a leading blank, no other normalisation.  Others are
refused with ``ValueError`` rather than encoded differently from the library.

Defined results: a null or empty text has the begin and end ids alone and decodes to
the empty string; rows that repeat are encoded each for itself, null ids stay;
other columns, also of clashing names, are ignored; an empty table gives no rows;
texts are encoded whole at any length.  ``decode`` takes any ids below the vocabulary's
size: invalid bytes become U+FFFD each, control ids nothing.
"""

from __future__ import annotations

import codecs
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

MARK = "▁"
#: Entries of one generation of a worker's caches, and characters of a cached part.
CACHE, CACHED_CHARS = 250_000, 64
#: Texts to encode between two record batches, in characters.
BATCH_CHARS = 1 << 22
_START, _UNKNOWN, _UNSET = -2, -3, -1


class Vocabulary:
    """The plain tables of a model: pieces, their ranks and kinds."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto
        m = proto.ModelProto()
        raw = SentencePieceProcessor(model_file=model_path).serialized_model_proto()
        m.ParseFromString(raw)
        self.key = hashlib.sha256(raw).hexdigest()
        t, n = m.trainer_spec, m.normalizer_spec
        kinds = [p.type for p in m.pieces]
        normal = [p.type == p.NORMAL for p in m.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == p.BYTE}
        if (t.model_type != t.BPE or not t.byte_fallback or len(self.bytes) != 256 or n.precompiled_charsmap or not n.add_dummy_prefix
                or n.remove_extra_whitespaces or not n.escape_whitespaces or t.treat_whitespace_as_suffix or any(p.type in (p.USER_DEFINED, p.UNUSED) for p in m.pieces)):
            raise ValueError("only BPE models with byte fallback, a leading blank and no other normalisation or own symbols")
        self.pieces = [p.piece for p in m.pieces]
        self.normal = normal
        self.control = [k == m.SentencePiece.CONTROL for k in kinds]
        self.unknown = self.pieces.index(t.unk_piece)
        self.unknown_surface = t.unk_surface
        self.begin, self.end = self.pieces.index(t.bos_piece), self.pieces.index(t.eos_piece)
        if any(MARK in p.lstrip(MARK) for p, x in zip(self.pieces, normal, strict=True) if x):
            raise ValueError("a piece has a blank behind another character")
        scores = sorted({-p.score for p, x in zip(m.pieces, normal, strict=True) if x})
        by_score = {s: k for k, s in enumerate(scores)}
        self.rank = [by_score[-p.score] if x else -1 for p, x in zip(m.pieces, normal, strict=True)]
        held: dict = {}
        for i, x in enumerate(normal):
            if x and len(self.pieces[i]) > 1:
                held.setdefault(self.rank[i], []).append(i)
        self.shared = {i for ids in held.values() if len(ids) > 1 for i in ids}
        if any(set(self.pieces[i]) != {MARK} for i in self.shared):
            raise ValueError("pieces of equal score that are not runs of blanks")


class Pieces:
    """Encoder and decoder over a ``Vocabulary``."""

    def __init__(self, v: Vocabulary):
        import ahocorasick
        self.v = v
        self.id = {p: i for i, p in enumerate(v.pieces) if v.normal[i]}
        self.chars = {p for p in self.id if len(p) == 1}
        self.left = [-1] * len(v.pieces)
        self.right = [-1] * len(v.pieces)
        self.plain: set[int] = set(v.shared)        # pairs of these are replayed on characters
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            if self._tree(i) or len(p) == 1:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        # a token over one whose edges cannot be followed cannot be followed either
        for i in sorted(self.id.values(), key=lambda i: len(v.pieces[i])):
            x, y = self.left[i], self.right[i]
            if x >= 0 and (x in self.plain or y in self.plain or (self.left[x] >= 0 and v.rank[x] >= v.rank[i]) or (self.left[y] >= 0 and v.rank[y] >= v.rank[i])):
                self.plain.add(i)
        self.pairs: dict[int, bool] = {}
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        self.byte_ids = [v.bytes[b] for b in range(256)]
        # for decoding: the bytes of each id
        self.surface = [b"" if v.control[i] else p.replace(MARK, " ").encode() for i, p in enumerate(v.pieces)]
        self.surface[v.unknown] = v.unknown_surface.encode()
        for b, i in v.bytes.items():
            self.surface[i] = bytes([b])
        self.begin, self.end = np.array([v.begin], "<u4").tobytes(), np.array([v.end], "<u4").tobytes()

    def _merged(self, text: str) -> list[int]:
        """The tokens of ``text`` by the merges themselves, for short texts over the vocabulary's characters."""
        symbols, rank = list(text), self.v.rank
        last = (-1, -1)
        while len(symbols) > 1:
            best = min(((rank[i], k) for k in range(len(symbols) - 1) if (i := self.id.get(symbols[k] + symbols[k + 1], -1)) >= 0), default=None)
            if best is None:
                break
            k = best[1]
            last = self.id[symbols[k]], self.id[symbols[k + 1]]
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
        self._last = last
        return [self.id[s] for s in symbols]

    def _tree(self, i: int) -> bool:
        """Notes the last merge that makes token ``i``; whether merges make it at all."""
        piece = self.v.pieces[i]
        if len(piece) == 1 or any(c not in self.chars for c in piece) or self._merged(piece) != [i]:
            return False
        self.left[i], self.right[i] = self._last
        return True

    def _apart(self, p: int, t: int) -> bool:
        """Whether the tokens stay apart when their texts are joined."""
        v = self.v
        if p in self.plain or t in self.plain:
            return self._merged(v.pieces[p] + v.pieces[t]) == [p, t]
        pieces, rank, never = v.pieces, v.rank, len(v.pieces)
        edge, grows = [p], []           # the right edge of p, whole token first, and the ranks at which it grows
        while self.right[edge[-1]] >= 0:
            grows.append(rank[edge[-1]])
            edge.append(self.right[edge[-1]])
        edge_t, grows_t = [t], []
        while self.left[edge_t[-1]] >= 0:
            grows_t.append(rank[edge_t[-1]])
            edge_t.append(self.left[edge_t[-1]])
        i, j = len(edge) - 1, len(edge_t) - 1
        while True:
            grow = grows[i - 1] if i else never
            grow_t = grows_t[j - 1] if j else never
            across = self.id.get(pieces[edge[i]] + pieces[edge_t[j]], -1)
            # of equal ranks the leftmost merge comes first
            if across >= 0 and rank[across] < grow and rank[across] <= grow_t:
                return False
            if not i and not j:
                return True
            if grow <= grow_t:
                i -= 1
            else:
                j -= 1

    def _part(self, s: str) -> list[int]:
        """Ids of ``s`` through the table of last tokens."""
        last = [_UNSET] * (len(s) + 1)
        last[0] = _START
        if not self.chars.issuperset(s):
            for k, c in enumerate(s, 1):
                if c not in self.chars:
                    last[k] = _UNKNOWN
        pairs, apart = self.pairs, self._apart
        for e, (t, n) in self.automaton.iter(s):
            e += 1
            if last[e] != _UNSET:
                continue
            p = last[e - n]
            if p >= 0:
                key = p << 32 | t
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= 2 * CACHE:
                        pairs.clear()
                    fits = pairs[key] = apart(p, t)
                if fits:
                    last[e] = t
            elif p != _UNSET:
                last[e] = t
        ids, k, pieces = [], len(s), self.v.pieces
        while k:
            t = last[k]
            if t == _UNKNOWN:
                k -= 1
                ids.extend(self.byte_ids[b] for b in reversed(s[k].encode()))
            else:
                ids.append(t)
                k -= len(pieces[t])
        ids.reverse()
        return ids

    def _learn(self, part: str) -> bytes:
        found = self.old_parts.get(part)
        if found is None:
            if "\n" in part and part != "\n" and "\n" not in self.chars:      # a border, and what is around it repeats
                found = b"".join(self._ids(x) for x in re.split("(\n)", part) if x)
            else:
                found = np.array(self._part(part), "<u4").tobytes()
        if len(part) <= CACHED_CHARS:
            if len(self.parts) >= CACHE:
                self.old_parts, self.parts = self.parts, {}
            self.parts[part] = found
        return found

    def _ids(self, part: str) -> bytes:
        return self.parts.get(part) or self._learn(part)

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of ``text`` with begin and end ids."""
        if not text:
            return self.begin + self.end
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            parts = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", MARK + text.replace(" ", MARK))
        else:
            parts = (MARK + text.replace(" ", " " + MARK)).split(" ")
        found = list(map(self.parts.get, parts))
        if None in found:
            found = [x or self._ids(part) for x, part in zip(found, parts, strict=True)]
        return b"".join((self.begin, *found, self.end))

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        out = b"".join(map(self.surface.__getitem__, numbers))
        v = self.v
        first = next((i for i in numbers if not v.control[i]), -1)
        if first >= 0 and v.normal[first] and v.pieces[first].startswith(MARK):
            out = out[1:]
        return out.decode("utf-8", "one-mark-per-byte")


def _one_mark(error: UnicodeError):
    return "�", error.start + 1


def _worker_pieces(v) -> Pieces:
    """The encoder of this Python worker; Spark reuses its workers, so a later task
    finds the parts of the earlier ones."""
    import sys
    import types
    codecs.register_error("one-mark-per-byte", _one_mark)
    held = sys.modules.setdefault("worker_pieces", types.ModuleType("worker_pieces"))
    if getattr(held, "key", None) != v.value["key"]:
        vocabulary = Vocabulary.__new__(Vocabulary)
        vocabulary.__dict__.update(v.value)
        held.key, held.pieces = vocabulary.key, Pieces(vocabulary)
    return held.pieces


def _broadcast(spark, model_path: str):
    """The vocabulary's tables as plain lists; their size is the model's, not the data's."""
    return spark.sparkContext.broadcast(vars(Vocabulary(model_path)))


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids): begin id, ids of the whole text, end id, as little-endian
    unsigned 32-bit integers."""
    tables = _broadcast(docs.sparkSession, model_path)

    def run(batches):
        p = _worker_pieces(tables)
        for b in batches:
            lo, ids, held = 0, [], 0
            for k, t in enumerate(b.column("text"), 1):
                ids.append(p.encode(t.as_py()))
                held += len(ids[-1])
                if held >= BATCH_CHARS or k == b.num_rows:
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, k - lo), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                                                     ["doc_id", "n_tokens", "ids"])
                    lo, ids, held = k, [], 0

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text) of rows as ``encode`` makes them; null ids give a null text."""
    tables = _broadcast(encoded.sparkSession, model_path)

    def run(batches):
        p = _worker_pieces(tables)
        for b in batches:
            texts = [None if x is None else p.decode(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n_tokens", "ids")), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "text"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, n_tokens bigint, ids binary, text string")


def model_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentence_pieces(spark, sf_dir):
    path = model_file()
    out = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
