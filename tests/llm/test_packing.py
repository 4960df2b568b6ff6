import collections
import random
import string
import unicodedata
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.common import prepare

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def same(library, text):
    flat, starts = packing.words(PATH).encode([text.encode("utf-8", "replace"), b"x"])
    assert flat[:starts[1]].tolist() == library(text.encode("utf-8", "replace").decode())
    assert flat[starts[1]:].tolist() == library("x")


@pytest.mark.parametrize("text", ["", " ", "It's THE 's end.", "a.b!! c,' '. x'. don't.", "É é İ İ K ΣΑΣ ß", "x\xa0y z w",
                                  "\x1ca\x1db \x85c", "1234 5.6%", "<|endoftext|> a", "(a) b) c:(", "日本 語. 😀!", "á. ́b"])
def test_ids(library, text):
    same(library, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60) | st.text(alphabet="aB's.,!1é́ \n", max_size=60))
def test_any_ids(library, text):
    same(library, text)


@pytest.mark.parametrize("text", ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a", "The T\u0308A. \u00c9 H\u0331. H\u0331 J\u030cx!"])
def test_marks_composed_in_lower_case_only(library, text):
    same(library, text)


def test_composing_marks():
    """A character that changes how a letter of ASCII composes begins with one of the bytes looked for."""
    marks = [c for c in map(chr, range(128, 0x110000)) if unicodedata.combining(unicodedata.normalize("NFD", c)[0])]
    composing = [m for m in marks for x in string.ascii_letters if unicodedata.normalize("NFC", x + m)[0] != x]
    assert len(composing) > 100 and all(m.encode()[:1] in packing._COMPOSING for m in composing)


@pytest.mark.parametrize("text", ["a <|endoftext|> x<|STARTOFTEXT|>.", "<|endoftext|>", "The<|startoftext|>END.!,", "<|EndOfText|> A",
                                  "<|endoftext|", "A<|endoftext|>\u0338 T\u0308<|endoftext|><|endoftext|>.", "<| B |>, <|b", "\u00c9<|endoftext|>\u00c9"])
def test_control_tokens(library, text):
    same(library, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "A", "b.", " ", "\u0308", "\u0338", "\u00c9", "\n"]), max_size=12).map("".join))
def test_any_control_tokens(library, text):
    same(library, text)


def test_a_control_token_is_one_id():
    flat, _ = packing.words(PATH).encode([b"a <|endoftext|> b"])
    assert flat.tolist()[1] == 49407


def plain_best_fit(lengths, capacity):
    rooms, out = [], []
    for n in lengths:
        fit = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if not fit:
            rooms.append(capacity)
            fit = [(capacity, len(rooms) - 1)]
        r, _ = min(fit)
        out.append(r)
        i = max(i for x, i in fit if x == r) if len(fit) > 1 else fit[0][1]
        rooms[i] -= n
    return len(rooms), out


@pytest.mark.parametrize("seed", range(5))
def test_best_fit(seed):
    r = random.Random(seed)
    lengths = sorted((r.randint(1, 64) for _ in range(300)), reverse=True)
    got = packing.best_fit(lengths, 64)
    n, rooms = plain_best_fit(lengths, 64)
    assert max(w for w, _ in got) + 1 == n
    assert [64 - o for _, o in got] == rooms  # the tightest room each time


def check(rows, docs, library, capacity=4096):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, text in docs:
        ids = [*library(text or ""), 2]
        own = sorted(by_doc.pop(i), key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert all(r.doc_tokens == len(ids) for r in own) and sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    assert not by_doc
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert sum(r.length for r in own) <= capacity
    return by_seq


def test_documents(spark, library):
    prepare(spark)
    texts = ["one two", None, "", "word " * 700, "same", "same"]
    docs = spark.createDataFrame([(i, t, 5, "s") for i, t in enumerate(texts)], "doc_id long, text string, start int, length string")
    rows = packing.packed(docs, PATH, 2, capacity=64, shard_pieces=4).collect()
    check(rows, list(enumerate(texts)), library, 64)
    assert packing.packed(docs.limit(0), PATH, 2).count() == 0
    twice = docs.selectExpr("cast(null as long) as doc_id", "text")
    assert packing.packed(twice, PATH, 2, capacity=64).count() == len(rows)
    parts = packing.pieces(docs, PATH, 2, capacity=64, with_ids=True)
    packed = packing.pack(parts, capacity=64).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in packed)


def test_equal_pieces(spark, library):
    prepare(spark)
    equal, texts = 400, [f"text {i} " + "more " * (i % 7) for i in range(100)]
    docs = spark.createDataFrame([(None, "same words")] * equal + [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.packed(docs, PATH, 2, capacity=16, shard_pieces=50).collect()
    assert len(rows) == equal + len(texts)
    ids = np.array([*library("same words"), 2], "<u4")
    assert all((r.start, r.length, r.ids_crc32, r.doc_tokens) == (0, len(ids), zlib.crc32(ids.tobytes()), len(ids)) for r in rows if r.doc_id is None)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in windows.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()] and sum(n for _, n in own) <= 16
    shards = collections.Counter(r.sequence_id >> 32 for r in rows if r.doc_id is None)
    assert len(shards) == 10 and set(shards.values()) == {equal // 10}
    again = packing.packed(docs.repartition(7), PATH, 2, capacity=16, shard_pieces=50).collect()
    assert collections.Counter(again) == collections.Counter(rows)


def test_query(spark, library):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    windows = check(QUERIES["op8_packing"](spark, folder).collect(), docs, library)
    lengths = [sum(r.length for r in own) for own in windows.values()]
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in lengths)
    assert padding <= 0.03 * sum(lengths), (padding, sum(lengths))
