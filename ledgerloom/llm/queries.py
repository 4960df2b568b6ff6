"""The operators as queries over the test tables, with SQL twins where SQL can state them."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, caps, ctw, langid, licenses, lines, packing, phrases, quality, runs, simhash, speculate, topk
from .license_texts import NOTICES
from .common import prepare, remainder, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return add


@query("op1_byte_bpe")
def op1(spark, folder):
    """Digests of every text's token ids and of what they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(table(spark, folder, "documents"), path, pattern)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(bpe.joined_ids("ids"), 256).alias("ids_sha256"),
                      F.sha2(bpe.decode("ids", path, pattern), 256).alias("decoded_sha256"))


@query("op2_language")
def op2(spark, folder):
    """Predicted language of every text; a quarter of the documents is never learned from."""
    docs = table(spark, folder, "documents")
    model = langid.train(docs.filter(remainder("doc_id", 4) != 2))
    out = langid.identify(docs, model, into="l")
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "l.lang_pred", "l.score")


@query("op3_simhash")
def op3(spark, folder):
    """Fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(table(spark, folder, "documents"))
    return out.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


_NOTICE_ROWS = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in NOTICES.items())
_NOTICE_SQL = rf"""
with notices(notice, text) as (values {_NOTICE_ROWS}),
notice_words as (select notice, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') as w from notices),
sized as (select *, least(5, len(w)) as k from notice_words),
wanted as (select distinct notice, k, array_to_string(w[i:i + k - 1], ' ') as s
           from (select notice, k, w, unnest(range(1, len(w) - k + 2)) as i from sized)),
words as (select row_number() over () as r, doc_id,
                 list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') as w from documents),
sizes as (select distinct k from sized),
held as (select distinct r, doc_id, k, array_to_string(w[i:i + k - 1], ' ') as s
         from (select r, doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from words cross join sizes where len(w) >= k)),
found as (select h.r, h.doc_id, n.notice, count(*) as n_found from held h join wanted n on h.k = n.k and h.s = n.s group by all),
total as (select notice, count(*) as n_shingles from wanted group by notice)
select doc_id, notice, n_shingles::int as n_shingles, n_found::int as n_found, n_found / n_shingles as containment
from found join total using (notice) where n_found / n_shingles >= 0.8"""


@query("op4_license_scan", _NOTICE_SQL)
def op4(spark, folder):
    """The licence notices in every text."""
    return licenses.scan(table(spark, folder, "documents"), NOTICES)


_LINE_SQL = r"""
with docs as (select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
split as (select r, doc_id, unnest(string_split(text, chr(10))) as line,
                 generate_subscripts(string_split(text, chr(10)), 1) as i from docs),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from split),
common as (select k, max(doc_id) as keeper from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
marked as (select s.*, c.k is not null and s.doc_id is distinct from c.keeper as lost from keyed s left join common c on s.k = c.k)
select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not lost), '')) as kept_sha256
from marked group by r, doc_id"""


@query("op5_line_dedup", _LINE_SQL)
def op5(spark, folder):
    """Every text without lines that many documents share."""
    out = lines.dedup_lines(table(spark, folder, "documents"), into="l")
    return out.select("doc_id", "l.n_lines", "l.n_dropped", F.sha2("l.kept", 256).alias("kept_sha256"))


@query("op6_embedding_caps")
def op6(spark, folder):
    """Links and component of every vector."""
    return caps.near_duplicates(table(spark, folder, "embeddings"))


@query("op7_quality")
def op7(spark, folder):
    """Quality of every text; a fifth of the documents is never learned from."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.train(docs, labels.filter(remainder("doc_id", 5) != 0))
    out = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), quality.scorer(spark, model)("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op8_packing")
def op8(spark, folder):
    """Pieces of every document in windows of 4096 tokens."""
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


_TOP_SQL = """
with v as (select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(64 * x::double)) as x from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
          from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, rank::int as rank, vec_id, score from
  (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs) where rank <= 20"""


@query("op9_exact_top_k", _TOP_SQL)
def op9(spark, folder):
    """The 20 best inner products of every twentieth vector with all others."""
    return topk.top_k(table(spark, folder, "embeddings"))


@query("op10_ctw_scores")
def op10(spark, folder):
    """Unigram and context-tree scores of every text; a fifth of the documents is never learned from."""
    out = ctw.score(table(spark, folder, "documents"), remainder("doc_id", 5) != 1)
    held = F.coalesce(remainder("doc_id", 5) == 1, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query("op11_speculative_bpe")
def op11(spark, folder):
    """Digests of every text's ids by the tokenizer file and of the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = speculate.encode(table(spark, folder, "documents"), path)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2(speculate.decode("ids", path).cast("binary"), 256).alias("decoded_sha256"))


_PHRASE_SQL = r"""
with docs as (select coalesce(lang, 'und') as lang,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from docs),
words as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
grams as (select lang, w[i:i + m - 1] as g from places, (select unnest([1, 2, 3, 4]) as m) where i + m - 1 <= len(w)),
f as (select lang, g, count(*) as a from grams group by lang, g having count(*) >= 30),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
cand as (select * from f where len(g) > 1),
cuts as (select c.lang, c.g, c.a, k, l.a as l, r.a as r, ((2000000::hugeint * c.a) // (l.a::hugeint + r.a))::bigint as score
         from (select *, unnest(range(1, len(g))) as k from cand) c
         join f l on l.lang = c.lang and l.g = c.g[1:k] join f r on r.lang = c.lang and r.g = c.g[k + 1:len(c.g)]),
lowest as (select *, row_number() over (partition by lang, g order by score, k) as pick from cuts),
inner_parts as (select lang, a, unnest(list_transform(range(1, len(g) - m + 2), lambda i: g[i:i + m - 1])) as part
                from cand, (select unnest([2, 3]) as m) where m < len(g)),
covered as (select lang, part, max(a) as most from inner_parts group by lang, part),
kept as (select w.lang, array_to_string(w.g, ' ') as phrase, w.a, w.l, w.r, w.score
         from lowest w left join covered v on v.lang = w.lang and v.part = w.g
         where pick = 1 and (v.most is null or 100 * v.most::hugeint < 80 * w.a::hugeint)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000"""


@query("op12_phrases", _PHRASE_SQL)
def op12(spark, folder):
    """The 2,000 best phrases of each language by the lowest score of their cuts."""
    return phrases.collocations(table(spark, folder, "documents"))


def _with_repeated_tails(docs: DataFrame) -> DataFrame:
    """Texts with a planted period: where crc32 h of the id divides by ten, the n words from a = h/10 % n on repeat
    the first p = 1 + (n-a) / (3 + h/10 % 8) of them; other texts stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = F.try_mod(g, n).cast("int")
    p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col("text")))


@query("op13_periodic_runs")
def op13(spark, folder):
    """Runs of repeated words in every text, the longest of them, and a digest of the text without the repeats."""
    out = runs.find(_with_repeated_tails(table(spark, folder, "documents").select("doc_id", "text")), into="r")
    top = F.col("top")
    line = F.transform("r.runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return out.withColumn("top", runs.longest(F.col("r.runs"))).select(
        "doc_id", F.size("r.runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
        top["period"].alias("period"), F.floor(top["length"] * 1000 / top["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("r.collapsed", 256).alias("collapsed_sha256"),
        F.col("r.n_words").alias("n_words"))
