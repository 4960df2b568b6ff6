import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import bpe
from ledgerloom.llm.common import prepare

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "  ", "a", "a  b", "a \n b", " lead", "trail ", "don't we'll 's '", "aaaa" * 300, "ab" * 700, "=" * 999,
         "x1 22 3½ é́    z", "😀👩‍👩‍👧", "the cat\nsat on\r\n\r\n the   mat\t\tend", "<|endoftext|> hi",
         "The and attion to thanedble the, anea. Eriner thanea.\n", "zq" * 2000 + " word"]


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(library, text):
    flat, starts = bpe.codec(PATH, P.PATTERN).encode([text])
    assert flat.tolist() == library.encode_ordinary(text)
    assert bpe.codec(PATH, P.PATTERN).decode(flat.astype(np.int64)) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab \n'sté1", max_size=600))
def test_any_text(library, text):
    test_as_the_library(library, text)


def test_one_wide_match(library):
    text = "".join(np.random.default_rng(1).choice(list("etaoinshrdlu"), 3000))
    test_as_the_library(library, text)


def test_table(spark, library):
    prepare(spark)
    rows = [(1, "Hello there", "x"), (2, None, "y"), (2, None, "y"), (None, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode(docs, PATH, P.PATTERN).withColumn("back", bpe.decode("ids", PATH, P.PATTERN)).collect()
    assert sorted((r[0] or 0, r[1], bytes(r[2])) for r in got) == [
        (0, [], b""), (1, library.encode_ordinary("Hello there"), b"Hello there"), (2, [], b""), (2, [], b"")]
    assert bpe.encode(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_query(spark, library):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op1_byte_bpe"](spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256(r.text.encode()).hexdigest())
