import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import speculate
from ledgerloom.llm.common import prepare

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


TEXTS = ["", " ", "  ", "a", "a  b", "a \n b", " lead", "trail ", "don't we'll 's '", "aaaa" * 300, "ab" * 700, "=" * 999,
         "x1 22 3½ é́    z", "😀👩‍👩‍👧", "the cat\nsat on\r\n\r\n the   mat\t\tend", "<|endoftext|> hi", "a<|endoftext|><|endoftext|>",
         "x <|endoftext|> y  <|endof", "The and attion to thanedble the, anea.\n", "zq" * 2000 + " word", "a͸b 12\U0001e6c0 ꟎՘c",
         "one\x85two three　 four\x1c\x1dfive"]


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(library, text):
    own = speculate.speculator(PATH)
    flat, starts = own.encode([text])
    assert flat.tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.decode(flat) == library.decode(flat.tolist(), skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab \n'sté1", max_size=600) | st.text(alphabet="etaoin shr", max_size=400))
def test_any_text(library, text):
    test_as_the_library(library, text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50_300), max_size=12))
def test_any_ids(library, ids):
    assert speculate.speculator(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_the_check_alone_is_right():
    """Two tokens are compatible exactly if merging their bytes gives the two again."""
    own, rng = speculate.speculator(PATH), np.random.default_rng(1)
    a, b = rng.integers(0, 50_256, (2, 20_000))
    near = rng.integers(256, 50_256, 5_000)  # parts of tokens next to each other, which rarely stay apart
    a, b = np.concatenate([a, own.left[near]]), np.concatenate([b, own.right[near]])
    word = lambda i: own.spelled[own.starts[i]:own.starts[i] + own.lengths[i]].tobytes()
    merged = own.merge([word(x) + word(y) for x, y in zip(a, b)])
    assert own.compatible(a, b).tolist() == [m == [x, y] for m, x, y in zip(merged, a.tolist(), b.tolist())]
    assert not own.compatible(own.left[near], own.right[near]).any()


def test_long_words_merge_alike():
    own, rng = speculate.speculator(PATH), np.random.default_rng(2)
    words = ["".join(rng.choice(list("etaoinshrdlu="), 60)).encode() for _ in range(300)] + [b"a" * 60, b"ab" * 30]
    assert own.merge(words) == [own._merge_long([own.single[b] for b in w]) for w in words]


def test_a_file_without_the_property_is_merged_exactly():
    own = speculate.Speculator(PATH)
    text = "The cat sat on the mat, thanedble."
    want = own.encode([text])[0].tolist()
    own._forget()
    own.settled = False
    assert own.encode([text])[0].tolist() == want


def test_memory_starts_anew(monkeypatch, library):
    monkeypatch.setattr(speculate, "REMEMBERED", 3)
    own = speculate.Speculator(PATH)
    for text in ["one two three four five", "six <|endoftext|>seven", "one two eight"]:
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_table(spark, library):
    prepare(spark)
    rows = [(1, "Hello there", "x"), (2, None, "y"), (2, None, "y"), (None, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = speculate.encode(docs, PATH).withColumn("back", speculate.decode("ids", PATH)).collect()
    want = library.encode("Hello there", add_special_tokens=False).ids
    assert sorted((r[0] or 0, r[1], r[2]) for r in got) == [(0, [], ""), (1, want, "Hello there"), (2, [], ""), (2, [], "")]
    assert speculate.encode(docs.limit(0), PATH).count() == 0


def test_query(spark, library):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_speculative_bpe"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256(back.encode()).hexdigest())
