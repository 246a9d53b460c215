"""Byte-level BPE against a public library, and its defined results for odd input."""

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken

from fiscalmill.llm import bpe, queries
from fiscalmill.llm.common import text_arrays

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return bpe.Encoder(vocabulary)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(encoder, texts):
    ids, counts = encoder.encode(*text_arrays(pa.array(texts, pa.string())))
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def odd_texts():
    rnd = random.Random(3)
    fixed = [
        "", " ", "a", "it's 's x'll 'LL ''s\n's don''t 'r 're '", "  a  b\n\n c\t \td  ", "x　y  z\x85\x1c", "１２³ é́ ǅ \U0001f600",
        "a" * 2500, "abc" * 700 + "xyz" * 300, " " * 300 + "x", "no spaces" * 300, "<|endoftext|> [INST]",
    ]
    near = ["".join(rnd.choice("ab'st rvelmd\n\t 1²é .!") for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    far = ["".join(chr(rnd.choice([rnd.randint(32, 126), rnd.randint(160, 0x2FFF), rnd.randint(0x1F300, 0x1F600)])) for _ in range(rnd.randint(0, 40))) for _ in range(100)]
    return fixed + near + far


def test_ids_equal_the_library(encoder, library):
    texts = odd_texts()
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_pieces_of_every_code_point(encoder):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1 << 16):
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}!" for c in points[at : at + (1 << 16)])
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = np.flatnonzero(bpe.piece_starts(codes, np.array([0]), encoder.kinds)).tolist()
        assert starts == [m.start() for m in regex.finditer(public_tokenizers.PATTERN, text)]


def test_long_texts_are_cut_where_pieces_begin(encoder, library):
    text = " ".join(t for t in odd_texts() if len(t) < 400)
    for limit in (1, 50, 1000):
        assert encoder.encode_long(np.frombuffer(text.encode(), np.uint8), limit).tolist() == library.encode_ordinary(text)
        assert len(encoder.cuts(np.frombuffer(text.encode(), np.uint8), limit)) > 3


def test_long_rows_and_matrices_agree(vocabulary, encoder):
    short = bpe.Encoder(vocabulary, long=4)
    texts = [t for t in odd_texts() if len(t) < 3000]
    assert encoded(short, texts) == encoded(encoder, texts)


def test_pieces_of_one_hash_stay_apart(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    texts = odd_texts()
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_new_pairs_of_smaller_rank_come_first(tmp_path):
    """A vocabulary whose ranks do not follow its merges: joining a and b opens a pair of smaller rank."""
    tokens = [bytes([b]) for b in range(256)] + [b"cd", b"abcd", b"aba", b"ab", b"abab"]
    (tmp_path / "ranks").write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    encoder = bpe.Encoder(bpe.Vocabulary.load(str(tmp_path / "ranks")))
    texts = ["abcdab", "ababab", "ababcdabab", "xabababcdx"]
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_query_on_odd_rows(spark, sf_dir, vocabulary, library):
    rows = [(None, None, 1), (None, "x y", 2), (5, "", 3), (5, "same same", 4), (5, "same same", 4), (6, "word " * 5000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").withColumnsRenamed({})
    out = bpe.digests(bpe.decode(bpe.encode(docs, vocabulary, 1000), vocabulary, 1000))
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert bpe.decode(bpe.encode(docs.limit(0), vocabulary), vocabulary).count() == 0

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in queries.op11_byte_bpe(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        assert found[doc_id]["n_tokens"] == len(ids)
        assert found[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_unknown_ids_raise(spark, vocabulary):
    bad = spark.createDataFrame([(1, bytearray(np.array([60000], "<u4").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="does not hold"):
        bpe.decode(bad, vocabulary).collect()
