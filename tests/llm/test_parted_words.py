"""Words of a text that differ in case or in a full stop or comma are encoded once, with the library's ids."""

import random

import numpy as np

from lumenlog.llm import tokens


def whole(enc, text):
    return np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, enc.dtype).tobytes()


def test_words_that_differ_in_case_or_stop_are_one():
    enc = tokens.Encoder(tokens.tokenizer_file())
    text = "Some words, some WORDS. some words, Words. Some words. Words, some"
    assert enc.encode_all([text]) == [whole(enc, text)]
    assert sorted(enc.words) == [b",", b".", b"some", b"words"]


def test_parted_texts_keep_the_ids():
    enc = tokens.Encoder(tokens.tokenizer_file())
    rng = random.Random(10)
    texts = ["J̌. ǰ, T̈ H̱ W̊ Y̊ İ.", "a.. b., c). d”. 5. it's. 's, x'. .\n,\n. , é. é. É, Σ. K.", "", ".", "A, b. <|ENDOFTEXT|> C.", "A. <|endoftext|>, B. <|StartOfText|>."]
    for letters in ("aAbJjHTWYIiéÉßΣσ.,;:!?'\"-() \n\t5٣”̱̌̈̊̇漢K#", "aAbZ's.,. ,\n \t'5)é”"):
        texts += ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(3000)]
    assert enc.encode_all(texts) == [whole(enc, t) for t in texts]


def test_stems_skip_normaliser_and_splitter():
    enc = tokens.Encoder(tokens.tokenizer_file())
    rng = random.Random(4)
    letters = [chr(x) for x in range(97, 0x250) if chr(x).isalpha() and chr(x) == chr(x).lower()]
    stems = list({"".join(rng.choices(letters if k % 2 else letters[:26], k=rng.randrange(1, 15))) for k in range(3000)})
    assert enc.stems.encode("A  B", add_special_tokens=False).ids != enc.tokenizer.encode("A  B", add_special_tokens=False).ids       # it does not lower-case
    got = enc._encode_stems([s.encode() for s in stems])
    assert all(got[s.encode()] == whole(enc, s) for s in stems)
