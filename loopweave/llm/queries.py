"""One query per operator over its whole table, with production parameters, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup as dedup
from . import (
    conversation_repair,
    fingerprints,
    html_text,
    jaccard_join,
    language_id,
    packing,
    phrase_mining,
    pii,
    sentence_piece,
    token_counts,
    top_k_search,
    toxicity,
)
from .common import bucket

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Key of the pseudonyms in the queries; a deployment passes its own secret.
PII_KEY = "an example key, not a secret"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file())


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY, found_col="found")
    return out.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), "found")


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(documents(spark, sf_dir), digest_all=True)


ORACLES["op3_exact_dedup"] = """
with n as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
           from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, text_sha256
from n window g as (partition by text_sha256)
"""


def piece_table(name: str = "piece_bpe_32k.model") -> sentence_piece.Pieces:
    import public_tokenizers

    return sentence_piece.Pieces.read(public_tokenizers.path(name))


@query
def op4_sentence_piece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_piece.encode(documents(spark, sf_dir), piece_table()).withColumn("n_pieces", F.size("ids").cast("long"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(documents(spark, sf_dir), tokenizer_file())
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.train(docs.where(bucket("doc_id", 4) != 2))
    out = language_id.identify(docs, model)
    return out.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir), words=4, percent=85)


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model | None:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.train(documents(spark, sf_dir), labels.where(bucket("doc_id", 5) != 0))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(documents(spark, sf_dir), toxicity_model(spark, sf_dir))
    return out.select("doc_id", (bucket("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(documents(spark, sf_dir))


ORACLES["op11_phrase_mining"] = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, row_number() over () as doc,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\n\x0b\x0c\r]')) as piece
    from documents),
split as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as w from pieces),
runs as (
    select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase, count(*)::hugeint as f
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
          from (select lang, w, unnest(range(1, 6)) as k from split) where len(w) >= k)
    group by all),
total as (select lang, sum(f)::hugeint as n from runs where k = 1 group by lang),
cand as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from runs where k > 1 and f >= 100),
held as (
    select distinct lang, a, array_to_string(w[i : i + j - 1], ' ') as phrase
    from (select lang, a, w, k, j, unnest(range(1, k - j + 2)) as i from (select *, unnest(range(2, k::bigint)) as j from cand))),
cuts as (
    select c.lang, c.phrase, c.a, i, l.f as l, r.f as r, n, 1000 * c.a * n // (l.f * r.f) as score
    from (select *, unnest(range(1, k)) as i from cand) c
    join total using (lang)
    join runs l on l.lang = c.lang and l.phrase = array_to_string(w[1:i], ' ')
    join runs r on r.lang = c.lang and r.phrase = array_to_string(w[i + 1:], ' ')
    where not exists (select 1 from held h where h.lang = c.lang and h.phrase = c.phrase and h.a >= c.a)),
worst as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, i) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from worst)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score from ranked where rank <= 2000
"""


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


@query
def op13_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


ORACLES["op13_top_k_search"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as code
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           list_sum(list_transform(list_zip(q.code, c.code), lambda p: p[1] * p[2]))::bigint as score
    from v q join v c on c.vec_id <> q.vec_id
    where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
