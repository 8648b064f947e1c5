"""Registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import divergence, fertility, graph_search, hard_negatives, licenses, line_dedup, mixing, near_duplicates, packing, passages, repeats, token_counts, token_files
from .shared import new_path, ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


LANGUAGE_WEIGHTS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def language_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the mix: the language of documents that have labels."""
    return labels.select("doc_id").distinct().join(docs.select("doc_id", F.col("lang").alias("domain")), "doc_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    domains = mixing.fit_domains(docs, language_labels(docs, _table(spark, sf_dir, "labels")), list(LANGUAGE_WEIGHTS))
    mixed = mixing.mixed_rates(docs.select("doc_id", "text"), domains, LANGUAGE_WEIGHTS)
    shares = [F.col("posterior")[k].alias(f"share_{name}") for k, name in enumerate(domains.names)]
    return mixed.select("doc_id", "n_tokens", *shares, "rate", "copies")


def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality_rules(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                                   public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-file")
    token_files.write_token_file(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.read_token_file(spark, path, with_ids=False)


def op9_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest_rows(_table(spark, sf_dir, "embeddings"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), label=label)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_packing, op2_mixing, op3_fertility, op4_licenses, op5_near_duplicates, op6_token_counts, op7_repeats,
    op8_token_files, op9_graph_search, op10_passages, op11_hard_negatives, op12_line_dedup, op13_divergence)}

ORACLES: dict[str, str] = {
    "op11_hard_negatives": """
with v as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
a as (select * from v where vec_id % 100 = 0),
scores as (
  select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same, list_sum(list_transform(list_zip(a.q, v.q), lambda z: z[1] * z[2]))::bigint as score
  from a join v on a.vec_id <> v.vec_id and len(a.q) = len(v.q)),
p as (
  select anchor_id, vec_id as positive_id, score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, (row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id))::int as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from p join scores n on n.anchor_id = p.anchor_id and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) <= 10""",
    "op12_line_dedup": """
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (select r, doc_id, i, l[i] as line from (select r, doc_id, l, unnest(generate_series(1, len(l))) as i from d)),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
found as (select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct r) >= 3),
marked as (select keyed.*, found.k is not null and keyed.doc_id is distinct from found.keeper as gone from keyed left join found on keyed.k = found.k)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by r""",
    "op13_divergence": r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
t as (select r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from d),
kept as (select lang, term, count(*) as n from t group by 1, 2 having count(distinct r) >= 30),
langs as (select lang, count(*) as v, sum(n) as total from kept group by 1),
counts as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by 1, 2, 3),
groups as (select lang, source, coalesce(any_value(v), 0) as v, coalesce(sum(n), 0) as total
           from (select distinct lang, source from d) left join langs using (lang) left join counts using (lang, source) group by 1, 2),
cells as (select g.lang, g.source, kept.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v)::hugeint as p
          from groups g join kept on kept.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
          from groups a join groups b on a.lang = b.lang and a.source <> b.source
          left join (select x.lang, x.source, y.source as other, sum(abs(x.p - y.p)) as value from cells x join cells y on x.lang = y.lang and x.term = y.term group by 1, 2, 3) s
          on s.lang = a.lang and s.source = a.source and s.other = b.source),
terms as (select c.lang, c.source, 'term' as part, c.term as item, (c.p - 1 - (1000000000::hugeint * (kept.n + 5)) // (langs.total + 5 * langs.v)::hugeint)::bigint as value
          from cells c join kept using (lang, term) join langs using (lang) where c.n > 0),
ranked as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
           from (select * from pairs union all select * from terms where value > 0))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50""",
}
