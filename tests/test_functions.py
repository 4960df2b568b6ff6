import random

from pyspark.sql import functions as F

from ledgerloom import functions as L


def test_hex_codec_matches_python_ints(spark):
    rnd = random.Random(7)
    texts = [None, "0x", "", "zz", "0x0", "0x" + "0" * 64, "0xFFf", "0xabc", "ff", hex(2**63 - 1), hex(2**63),
             hex(2**120 - 1), hex(2**120), hex(2**256 - 1)]
    texts += [hex(rnd.getrandbits(b)) for b in range(1, 257, 5)] + [hex(rnd.getrandbits(900))]
    rows = spark.createDataFrame([(t,) for t in texts], "h string").select(
        "h", L.hex_to_dec("h").alias("d"), L.hex_to_long("h").alias("n")).collect()
    for r in rows:
        try:
            want = int(r.h, 16)
        except (TypeError, ValueError):
            want = None
        assert r.d == (None if want is None else str(want)), r.h
        assert r.n == (want if want is not None and want < 2**63 else None), r.h


def test_decimal_adjust_is_exact(spark):
    cases = [("0", 18, "0"), ("1", 18, "0.000000000000000001"), ("1000000000000000000", 18, "1"), ("-25", 1, "-2.5"),
             ("123456", 3, "123.456"), ("120", 1, "12"), ("abc", 2, None), (None, 2, None), (str(2**256), 18, None)]
    for text, n, want in cases:
        got = spark.createDataFrame([(text,)], "x string").select(L.decimal_adjust("x", n)).first()[0]
        if text == str(2**256):
            want = text[:-18] + "." + text[-18:].rstrip("0")
        assert got == want, (text, n)


def test_words_and_dynamic_array(spark):
    word = lambda n: format(n, "064x")
    data = "0x" + word(32) + word(2) + word(7) + word(9) + word(11) + "abcd"
    r = spark.createDataFrame([(data,)], "d string").select(
        L.words64("d").alias("w"), L.abi_array(L.words64("d")).alias("a"),
        L.word_address(F.lit(word(255))).alias("addr")).first()
    assert len(r.w) == 5 and r.a == [word(7), word(9)]
    assert r.addr == "0x" + format(255, "040x")


def test_surrogate_key_and_strict_greatest(spark):
    import hashlib
    r = spark.range(1).select(L.surrogate_key(F.lit("a"), F.lit(None).cast("string")).alias("k"),
                              L.greatest_strict(F.lit(1), F.lit(None).cast("int")).alias("g")).first()
    assert r.k == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest() and r.g is None
