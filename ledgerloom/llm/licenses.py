"""License scan: windows, MinHash bands and exact containment, in Column functions only.

Texts are sequences of words (runs of letters and digits, lower case) and sets of
shingles of five words; a notice of fewer words is one shingle of all its words.
Text windows overlap: ``2 * RUN`` shingles, a new one every ``RUN``. A notice is
cut into runs of ``RUN`` shingles, so each run lies within one text window, and
the two have a Jaccard similarity of 1/2 at least. A window has ``BANDS`` bands of
one MinHash row each, so a run in a text is missed with probability 2^-BANDS. The
notices of fewer shingles than a run would fill too little of such a window: theirs
are windows of one shingle, whose MinHash is the shingle itself, which misses
nothing. Retrieved notices are kept if the text holds at least ``CONTAINMENT`` of
the notice's distinct shingles, compared as text.

The notices are a parameter; their number of shingles is checked against
``MAX_SHINGLES``, as their bands are literals of the plan. The scan is one narrow
stage: no shuffle, no join, nothing broadcast.

Defined results: null, empty and short texts have no notice; a row that repeats
gives its notices each time; a notice without words is never found.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

WIDTH = 5
RUN = 8
BANDS = 12
CONTAINMENT = 0.8
MAX_SHINGLES = 100_000
_SEEDS = [int(x) for x in np.random.default_rng(20).integers(-2**63, 2**63 - 1, BANDS // 2)]


def words_of(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def hashes(words: str, size: int = WIDTH) -> Column:
    """A hash of each run of ``size`` words."""
    w = F.col(words)
    return F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))).otherwise(_empty("bigint"))


def seeded(hashed: str) -> Column:
    """The hashes under half as many hash functions as there are bands."""
    def under(seed: int):
        return F.transform(hashed, lambda x: x.bitwiseXOR(F.lit(seed)))

    return F.struct(*[under(s).alias(f"x{k}") for k, s in enumerate(_SEEDS)])


def bands(seeded_col: str, size: int, step: int) -> Column:
    """Band values of the windows of ``size`` hashes that begin every ``step``: the least and the greatest value of each function."""
    first = F.col(f"{seeded_col}.x0")
    starts = F.when(F.size(first) > 0, F.sequence(F.lit(1), F.size(first), F.lit(step))).otherwise(_empty("int"))

    def of(at: Column) -> Column:
        parts = [F.slice(F.col(f"{seeded_col}.x{k}"), at, size) for k in range(len(_SEEDS))]
        return F.array(*[f(p) for p in parts for f in (F.array_min, F.array_max)])

    return F.flatten(F.transform(starts, of))


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Columns computed once: behind a generator, so that later steps do not compute them again."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _signatures(spark, notices: dict[str, str]) -> tuple[dict, dict, dict]:
    """Of the notices: literal band values and short shingle hashes with the notices each belongs to, and their shingles."""
    rows = spark.createDataFrame(list(enumerate(notices.values())), "n int, text string")
    rows = _once(rows, ["n"], w=words_of("text")).filter(F.size("w") > 0)
    rows = rows.withColumn("size", F.least(F.size("w"), F.lit(WIDTH)))
    out: dict[str, dict] = {"long": {}, "short": {}}
    exact = {}
    for r in rows.select("n", "size", "w").collect():
        exact[r.n] = (r.size, list(dict.fromkeys(" ".join(r.w[i:i + r.size]) for i in range(len(r.w) - r.size + 1))), set(r.w))
    if sum(len(s) for _, s, _ in exact.values()) > MAX_SHINGLES:
        raise ValueError(f"the notices have more than {MAX_SHINGLES} shingles")
    for size in sorted({s for s, _, _ in exact.values()}):
        hashed = _once(rows.filter(F.col("size") == size), ["n"], h=hashes("w", size))
        short = hashed.filter(F.size("h") < RUN) if size == WIDTH else hashed
        for r in short.collect():
            for h in r.h:
                out["short"].setdefault((size, h), set()).add(r.n)
        if size == WIDTH:
            run = _once(hashed.filter(F.size("h") >= RUN), ["n"], h=F.array_distinct(F.transform(
                F.concat(F.sequence(F.lit(1), F.size("h") - RUN + 1, F.lit(RUN)), F.array(F.size("h") - RUN + 1)),
                lambda i: F.slice("h", i, RUN))))
            run = _once(run.select("n", F.explode("h").alias("h")), ["n"], x=seeded("h"))
            for r in run.select("n", bands("x", RUN, RUN).alias("b")).collect():
                for b in r.b:
                    out["long"].setdefault(b, set()).add(r.n)
    return out["long"], out["short"], exact


def scan(docs: DataFrame, notices: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
         containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and notice it holds: id, notice, n_shingles, n_found, containment."""
    long, short, exact = _signatures(docs.sparkSession, notices)
    names = list(notices)

    def held(values: Column, table: dict[int, set[int]]) -> Column:
        """The notices that the values of ``table`` found among ``values`` belong to."""
        if not table:
            return _empty("int")
        found = F.array_intersect(values, F.array(*[F.lit(v) for v in table]))
        places = F.map_from_arrays(F.array(*[F.lit(v) for v in table]),
                                   F.array(*[F.array(*[F.lit(n) for n in sorted(ns)]) for ns in table.values()]))
        return F.flatten(F.transform(found, lambda v: F.element_at(places, v)))

    sizes = sorted({k for k, _ in short})
    by_size = {k: {h: ns for (s, h), ns in short.items() if s == k} for k in sizes}
    df = _once(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), ["id"], w=words_of("t"))
    df = _once(df, ["id", "w"], h=hashes("w"))
    df = _once(df, ["id", "w", "h"], x=seeded("h"))
    found = [held(bands("x", 2 * RUN, RUN), long)]
    for k in sizes:
        if k == WIDTH:
            found.append(held(F.col("h"), by_size[k]))
        else:  # only texts that hold a notice's words can hold its one shingle
            own = sorted({n for ns in by_size[k].values() for n in ns})
            there = F.lit(False)
            for n in own:
                there = there | (F.size(F.array_intersect("w", F.array(*[F.lit(x) for x in sorted(exact[n][2])]))) == len(exact[n][2]))
            found.append(F.when(there, held(hashes("w", k), by_size[k])).otherwise(_empty("int")))
    df = df.select("id", "w", F.explode(F.array_distinct(F.concat(*found))).alias("n"))
    sets = F.map_from_arrays(F.array(*[F.lit(n) for n in exact]),
                             F.array(*[F.array(*[F.lit(s) for s in ss]) for _, ss, _ in exact.values()])) if exact else None
    if sets is None:
        return docs.limit(0).select(id_col, F.lit("").alias("notice"), F.lit(0).alias("n_shingles"), F.lit(0).alias("n_found"),
                                    F.lit(0.0).alias("containment"))
    size = F.lit(WIDTH)
    for n, (k, _, _) in exact.items():
        if k != WIDTH:
            size = F.when(F.col("n") == n, F.lit(k)).otherwise(size)
    df = _once(df, ["id", "n", "w"], k=size, s=F.element_at(sets, F.col("n")))
    own = F.transform(F.when(F.size("w") >= F.col("k"), F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).otherwise(_empty("int")),
                      lambda i: F.array_join(F.slice("w", i, F.col("k")), " "))
    df = _once(df, ["id", "n"], n_shingles=F.size("s"), n_found=F.size(F.array_intersect(F.col("s"), own)))
    name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("n") + 1)
    return (df.withColumn("containment", F.col("n_found") / F.col("n_shingles")).filter(F.col("containment") >= containment)
            .select(F.col("id").alias(id_col), name.alias("notice"), "n_shingles", "n_found", "containment"))
