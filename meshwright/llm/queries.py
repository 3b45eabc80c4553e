"""One registered query per operator, over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm import byte_pairs, collocations, decontaminate, hadamard_centroids, hamming_trees, language_model, line_chunks, near_duplicates, quality_rules, subword_classifier, substrings, token_counts, url_filters
from meshwright.llm.common import table
from meshwright.session import cut


BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, BYTE_RANKS).drop("text")


def op2_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_pairs.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN, decoded="decoded").select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = lambda key: F.crc32(F.col(key).cast("string").cast("binary")) % 5
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"), fold("__key") != 0)
    return subword_classifier.score(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))\
        .select("page_id", "host", "path", "rule", "verdict")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics are measured once, written, and serve both learning and judging."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    measured = cut(quality_rules.text_statistics(docs, keep=["doc_id"]), "statistics")
    rules = quality_rules.learn_rules(measured.join(labels.select("doc_id", "quality"), "doc_id"))
    return quality_rules.apply_rules(measured, rules).select("doc_id", *quality_rules.BASE_COLUMNS, "base_failed", "kept", "rule")


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = language_model.fit(language_model.learning_rows(docs, ~held_out))
    return language_model.score(docs, model, counts).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates.near_duplicate_classes(docs).select("doc_id", "class_id", "n_links")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                         F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.drop_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_chunks.drop_repeated_chunks(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return collocations.collocations(*collocations.mine_phrases(docs))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = hadamard_centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    digests = F.lit([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""])
    return hadamard_centroids.with_inertia(assigned).withColumn("centroid_sha256", F.get(digests, F.col("cluster")))


def op13_hamming_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hamming_trees.near_duplicates(docs, keep=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_byte_pairs": op2_byte_pairs,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_url_filters": op4_url_filters,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_model": op6_language_model,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_decontamination": op8_decontamination,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_hamming_components": op13_hamming_components,
}

# What DuckDB can express.
_TEXT = r"""
with u as (
  select page_id, coalesce(url, '') as url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
s as (
  select *, split_part(host || path, '/', 1) as h, host || path as hp,
    case when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
         when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
         when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
         when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from u)
select page_id, host, path, rule,
  case rule when 'example.net/en/' then 'allow' when 'org/fr/' then 'allow' when 'example.com/de/' then 'block' when 'net/' then 'block'
  else case when regexp_matches(url, '(?i)/(wp-)?login(\.php)?([/?#]|$)') or regexp_matches(url, '(?i)/wp-admin/')
      or regexp_matches(url, '(?i)/(cart|checkout)([/?#]|$)') or regexp_matches(url, '(?i)/search/?\?')
      or regexp_matches(url, '(?i)/tag/[^/?#]+/page/[0-9]+') or regexp_matches(url, '(?i)/feed/?([?#]|$)')
      or regexp_matches(url, '(?i)://([^/?#]*\.)?ads\.') or regexp_matches(url, '(?i)://[^/?#]*\b(casino|porn|xxx)\b')
      or regexp_matches(url, '^[a-zA-Z]+://[0-9]{1,3}(\.[0-9]{1,3}){3}([:/?#]|$)')
    then 'block' else 'allow' end end as verdict
from s
"""
_PHRASES = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
lists as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
counts as (
  select lang, size, phrase, count(*) as f from (
    select lang, 1 as size, unnest(w) as phrase from lists
    union all
    select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from lists
    union all
    select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from lists)
  group by all),
totals as (select lang, cast(sum(f) as bigint) as n from counts where size = 1 group by lang),
cand as (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from counts where size >= 2 and f >= 10),
cuts as (
  select lang, phrase, a, 1 as k, w[1] as head, array_to_string(w[2:], ' ') as tail from cand
  union all
  select lang, phrase, a, 2, array_to_string(w[1:2], ' '), w[3] from cand where size = 3),
scored as (
  select c.lang, c.phrase, c.a, c.k, h.f as l, t.f as r,
         (1000000::hugeint * c.a * c.a) // (h.f::hugeint * t.f) as score
  from cuts c join counts h on c.lang = h.lang and c.head = h.phrase join counts t on c.lang = t.lang and c.tail = t.phrase),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, sub, max(a) as most from (
    select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as sub from cand where size = 3)
  group by all),
kept as (
  select s.* from lowest s left join longer g on s.lang = g.lang and s.phrase = g.sub
  where g.most is null or 100 * g.most < 50 * s.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select k.lang, cast(k.rank as bigint) as rank, k.phrase, k.a, cast(k.l as bigint) as l, cast(k.r as bigint) as r, t.n, cast(k.score as bigint) as score
from ranked k join totals t on k.lang = t.lang where k.rank <= 2000
"""


def _clusters(rounds: int = 3, k: int = 16) -> str:
    """Assignments by comparing every vector with every centroid, round by round."""
    parts = [f"""
v as materialized (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 64) as bigint)) as x from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as materialized (
  select row_number() over (order by h, x) - 1 as cluster, x as c from (
    select sha256('1:' || vec_id) as h, x from v where vec_id is not null order by h, x limit {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} as materialized (
  select rid, arg_min(cluster, d * {k} + cluster) as cluster, min(d) as d from (
    select rid, cluster, cast(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as d from v, c{r})
  group by rid)""")
        if r < rounds:
            parts.append(f"""
m{r} as materialized (
  select cluster, list(m order by i) as c from (
    select cluster, i, cast((s - ((s % n) + n) % n) // n as bigint) as m from (
      select a.cluster, i, sum(x[i])::bigint as s, count(*) as n from v join a{r} a using (rid), range(1, 65) t(i) group by a.cluster, i))
  group by cluster),
c{r + 1} as materialized (select c.cluster, coalesce(m.c, c.c) as c from c{r} c left join m{r} m using (cluster))""")
    return "with" + ",".join(parts) + f"""
select v.vec_id, cast(a.cluster as int) as cluster, a.d as distance,
       cast(sum(a.d) over (partition by a.cluster) as bigint) as cluster_inertia, cast(sum(a.d) over () as bigint) as inertia,
       sha256(array_to_string(c.c, ',')) as centroid_sha256
from v join a{rounds} a using (rid) join c{rounds} c on c.cluster = a.cluster
"""


SQL: dict[str, str] = {"op4_url_filters": _TEXT, "op11_phrase_collocations": _PHRASES, "op12_centroid_clusters": _clusters()}
