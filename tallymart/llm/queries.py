"""Registered queries of this package and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import (
    anomalies,
    byte_bpe,
    collocations,
    decontamination,
    exact_dedup,
    jaccard_join,
    language,
    periodic_runs,
    quality,
    secrets_scan,
    substring_dedup,
    surrogates,
    toxicity,
)
from tallymart.llm.shared import ship


#: Key of the registered query; a real job passes its own secret.
SURROGATE_KEY = "registered-query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.surrogates(spark, table(spark, sf_dir, "documents"), SURROGATE_KEY)


def ranks() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public tokenizer."""
    import public_tokenizers

    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(spark, table(spark, sf_dir, "documents"), *ranks())


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(spark, docs, benchmark)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(spark, table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.report(secrets_scan.secrets(spark, table(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(spark, table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.anomalies(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(spark, table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_quality": op2_quality,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_surrogates": op4_surrogates,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_decontamination": op6_decontamination,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_secrets": op8_secrets,
        "op9_language": op9_language,
        "op10_toxicity": op10_toxicity,
        "op11_anomalies": op11_anomalies,
        "op12_collocations": op12_collocations,
        "op13_periodic_runs": op13_periodic_runs,
    }


EXACT_DEDUP_SQL = """
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, sha256(norm) as text_sha256
from texts window same as (partition by norm)
"""

JACCARD_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
grams as (
  select doc_id, w[i:i + 4] as g from words, range(1, len(w) - 3) t(i) where len(w) >= 5
  union select doc_id, w from words where len(w) between 1 and 4),
sets as (
  select words.doc_id, coalesce(s, []) as s, coalesce(n, 0) as n from words left join (
    select doc_id, list(g order by g) as s, count(*) as n from (select distinct * from grams) group by doc_id) using (doc_id)),
nodes as (select doc_id, n, min(doc_id) over (partition by s) as node from sets),
node_grams as (select distinct node, n, g from grams join nodes using (doc_id) where node = doc_id),
links as (
  select a.node as a, b.node as b from node_grams a join node_grams b on a.g = b.g and a.node != b.node
  group by a.node, b.node, a.n, b.n having 5 * count(*) >= 4 * (a.n + b.n - count(*))),
reach as (select node as a, node as b from nodes union select reach.a, links.b from reach join links on reach.b = links.a),
classes as (select a as node, min(b) as class_id from reach group by a)
select doc_id, class_id, (select count(*) from links where a = node) as n_links
from nodes join classes using (node)
"""

SUBSTRING_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, array_to_string(w[i:i + 19], ' ') as k from words, range(1, len(w) - 18) t(i) where len(w) >= 20),
repeated as (
  select doc_id, i from windows qualify row_number() over (partition by k order by doc_id, i) > 1),
covered as (select distinct doc_id, i + j as place from repeated, range(0, 20) r(j)),
kept as (
  select doc_id, string_agg(word, ' ' order by place) as t, count(*) as n
  from (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place from words)
  anti join covered using (doc_id, place) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(t, '')) as kept_sha256
from words left join kept using (doc_id)
"""

COLLOCATIONS_SQL = r"""
with lowered as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from lowered)),
grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f
  from pieces, range(1, 4) s(k), range(1, len(w) - k + 2) t(i) group by all),
totals as (select lang, cast(sum(f) as bigint) as n from grams where k = 1 group by lang),
frequent as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from grams where k > 1 and f >= 10),
cuts as (
  select c.*, j, x.f as l, y.f as r, (1000000::hugeint * a * a) // (x.f::hugeint * y.f) as score
  from (select *, unnest(range(1, k)) as j from frequent) c
  join grams x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:j], ' ')
  join grams y on y.lang = c.lang and y.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
worst as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (
  select lang, phrase, max(f) as most from (
    select lang, array_to_string(w[i:i + 1], ' ') as phrase, a as f from frequent, range(1, 3) t(i) where k = 3)
  group by all),
kept as (
  select worst.* from worst left join inside using (lang, phrase)
  where k = 3 or most is null or 100 * most < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP_SQL,
        "op3_jaccard_join": JACCARD_SQL,
        "op7_substring_dedup": SUBSTRING_SQL,
        "op12_collocations": COLLOCATIONS_SQL,
    }
