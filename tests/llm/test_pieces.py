"""SentencePiece encoding against the library: ids, spans and decoded texts, with and without a character map."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from adresponse.llm import pieces, registry
from tests.llm.test_operators import SF, awkward, documents, empty

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "▁", "é", "一", "\U0001f600", "\0", "the", "ing", "<s>", "1", "́", "ＡＢ", "㍿", " ", "　", "¨", "\r\n", "ﬁ", "İ", "é"]


def odd_texts(n=1500, seed=5):
    rng = random.Random(seed)
    return ["", " ", "  ", "▁", "\0", *("".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(n))]


def same_as_library(codec, library, texts):
    ids, begins, ends, counts = codec.encode(texts)
    rows, at = list(zip(ids.tolist(), begins.tolist(), ends.tolist())), 0
    for t, k in zip(texts, counts.tolist()):
        assert rows[at : at + k] == [(p.id, p.begin, p.end) for p in library.encode(t, return_type="proto").pieces], t
        at += k
    for t, d in zip(texts, codec.decode(ids, counts)):
        assert d == library.decode(library.encode(t)), t
    rng = random.Random(6)  # ids in any order: bytes that are no UTF-8, unknowns, controls
    some = [[rng.randrange(300) if rng.random() < 0.6 else rng.randrange(32000) for _ in range(rng.randrange(12))] for _ in range(800)]
    decoded = codec.decode(np.array(sum(some, []), dtype=np.int32), np.array([len(x) for x in some]))
    assert decoded == [library.decode(x) for x in some]


def test_odd_texts_as_the_library():
    same_as_library(pieces.Codec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL), odd_texts())


def message(number, body):
    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    return varint(number << 3 | 2) + varint(len(body)) + body


def with_normalizer(rule, dummy, squeeze, folder):
    """The model with the compiled character map of a rule; a later message adds to the earlier one, so settings are put last."""
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, remove_extra_whitespaces=squeeze, escape_whitespaces=True)
    spec = [v for k, v in pieces.fields(made.serialized_model_proto()) if k == 3][0]
    path = f"{folder}/{rule}-{dummy}-{squeeze}.model"
    with open(MODEL, "rb") as f, open(path, "wb") as g:
        kept = b"".join(message(k, v) for k, v in pieces.fields(f.read()) if k in (1, 2))
        g.write(kept + message(3, spec))
    return path


@pytest.mark.parametrize("rule, dummy, squeeze", [("nmt_nfkc", True, True), ("nfkc", True, False), ("nmt_nfkc_cf", False, True), ("nmt_nfkc", False, False)])
def test_character_maps_as_the_library(rule, dummy, squeeze, scratch):
    path = with_normalizer(rule, dummy, squeeze, scratch)
    same_as_library(pieces.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path), odd_texts(600, 7))


def test_long_units_and_a_full_cache(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 50)
    codec, library = pieces.Codec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(1)
    long = "".join(rng.choice("abcdeéing一") for _ in range(20_000))
    same_as_library(codec, library, [long, "x" * 5000, " ".join(f"w{i}" for i in range(500)), "\n" * 100])
    assert len(codec.slot) <= 50
    same_as_library(codec, library, ["after the cache was cut w3 w499"])


def test_query_is_the_library_on_every_document(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in registry.op11_sentencepiece(spark, SF).collect()}
    rows = documents(spark).collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "")
        g = got[r.doc_id]
        assert g.n_tokens == len(ids) and g.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert g.source_bytes == len((r.text or "").encode())


def test_awkward_rows_and_both_ways(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    df = awkward(spark)
    rows = pieces.decode(pieces.encode(df, MODEL), MODEL).collect()
    want = sorted((str(r.doc_id), library.encode(r.text or ""), library.decode(library.encode(r.text or ""))) for r in df.collect())
    assert sorted((str(r.doc_id), list(r.ids), r.text) for r in rows) == want
    digests = pieces.digests(df, MODEL)
    assert digests.count() == 12 and digests.where(F.col("n_tokens") == 0).count() == 2
    assert pieces.digests(empty(spark, "documents"), MODEL).count() == 0
    # spans follow each other through the whole text
    for r in pieces.encode(df, MODEL).collect():
        assert all(a <= b for a, b in zip(r.begins, r.ends)) and all(a <= b for a, b in zip(r.ends, r.begins[1:]))


def test_other_models_are_refused(scratch):
    with open(MODEL, "rb") as f:
        kept = [(k, v) for k, v in pieces.fields(f.read()) if k in (1, 2)]
    unigram = b"".join(message(k, v) for k, v in kept if k == 1) + message(2, b"\x18\x01")
    with open(f"{scratch}/unigram.model", "wb") as f:
        f.write(unigram)
    with pytest.raises(ValueError):
        pieces.Codec(f"{scratch}/unigram.model")
