"""SentencePiece ids and texts against the library itself."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from lumenlog.llm import pieces
from lumenlog.llm.common import table

SF = "/root/testdata/sf0.001"
EDGES = ["", " ", "  a", "a ", "a\n\nb  c", "▁a", "a▁ b", "▁", "\x00a", "日本語😀", "<s>hi</s>", "a　b", "ﬁ Å", "\n", "\t\r\n x", " " * 40 + "a" + " " * 33, "x" * 5000, "é" * 300, "\U0001f9ff" * 9]


@pytest.fixture(scope="module")
def both():
    pieces.codecs.register_error("one-mark-per-byte", pieces._one_mark)
    return pieces.Pieces(pieces.Vocabulary(pieces.model_file())), SentencePieceProcessor(model_file=pieces.model_file())


def check(both, text):
    own, lib = both
    ids = lib.encode(text, add_bos=True, add_eos=True)
    raw = own.encode(text)
    assert np.frombuffer(raw, "<u4").tolist() == ids, text
    assert own.decode(raw) == lib.decode(ids), text


def test_edges(both):
    for text in EDGES:
        check(both, text)


def test_random_texts(both):
    r = random.Random(3)
    parts = [p.replace("▁", " ") for p in both[0].v.pieces[259:]] + [" ", "  ", "\n", "😀", "▁", "\x00"] * 500
    for _ in range(4000):
        check(both, "".join(r.choice(parts) for _ in range(r.randrange(12))))
    for _ in range(4000):
        check(both, "".join(r.choice(" ▁abcdetinghéß日.,(0\n") for _ in range(r.randrange(40))))


def test_decode_of_any_ids(both):
    own, lib = both
    r = random.Random(4)
    for _ in range(3000):
        ids = [r.randrange(len(own.v.pieces)) if r.random() < 0.5 else r.randrange(260) for _ in range(r.randrange(9))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids), ids


def test_pairs_against_their_merges(both):
    own, _ = both
    r = random.Random(5)
    usable = [i for i in own.id.values() if all(c in own.chars for c in own.v.pieces[i])]
    for _ in range(5000):
        p, t = r.choice(usable), r.choice(usable)
        assert own._apart(p, t) == (own._merged(own.v.pieces[p] + own.v.pieces[t]) == [p, t])


def test_small_caches(both, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 3)
    small = pieces.Pieces(both[0].v)
    for text in EDGES + ["the same words and the same words again"] * 3:
        assert small.encode(text) == both[0].encode(text)
    assert len(small.parts) <= 3 and len(small.old_parts) <= 3


def test_frames(spark, both):
    rows = [*enumerate(EDGES), (1, " "), (None, None), (None, "no id"), (77, None), (78, "long words " * 50_000)]
    df = spark.createDataFrame([(*x, "clash", 5) for x in rows], "doc_id long, text string, ids string, n_tokens int")
    out = pieces.decode(pieces.encode(df, pieces.model_file()), pieces.model_file()).collect()
    lib = both[1]
    want = [(d, lib.encode(t or "", add_bos=True, add_eos=True)) for d, t in rows]
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.n_tokens, r.text) for r in out), key=str) == sorted(((d, i, len(i), lib.decode(i)) for d, i in want), key=str)
    assert pieces.encode(df.limit(0), pieces.model_file()).count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None, None)], "doc_id long, n_tokens long, ids binary"), pieces.model_file()).first().text is None


def test_query_against_library(spark, both):
    lib = both[1]
    want = []
    for r in table(spark, SF, "documents").select("doc_id", F.coalesce("text", F.lit(""))).collect():
        ids = lib.encode(r[1], add_bos=True, add_eos=True)
        want.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, pieces.op11_sentence_pieces(spark, SF).collect())) == sorted(want)


def test_other_models_are_refused(tmp_path, both):
    from sentencepiece import sentencepiece_model_pb2 as proto
    for change in ("unigram", "normalised", "bytes", "ties"):
        m = proto.ModelProto()
        m.ParseFromString(open(pieces.model_file(), "rb").read())
        if change == "unigram":
            m.trainer_spec.model_type = m.trainer_spec.UNIGRAM
        elif change == "normalised":
            m.normalizer_spec.remove_extra_whitespaces = True
        elif change == "bytes":
            m.trainer_spec.byte_fallback = False
        else:
            m.pieces[400].score = m.pieces[401].score
        path = tmp_path / change
        path.write_bytes(m.SerializeToString())
        with pytest.raises((ValueError, RuntimeError)):
            pieces.Vocabulary(str(path))
