"""The queries of this package, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from causalgrid.llm import ann, lexical, lm_scoring, near_dedup, packing, passages, quality_rules, sentencepiece_lattice, sharding, spelling, suffix_dedup, token_counts, toxicity
from causalgrid.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(pin_utc(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    r"""
with parts as (
  select doc_id, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents),
judged as (
  select *, list_filter(lines, lambda l: not (
      length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) * 100 > 50 * len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> ''))
      or length(regexp_replace(l, '[^!]', '', 'g')) * 100 > 50 * len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> ''))
      or (len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) <= 2 and not regexp_matches(l, '[\pP][\x20\x09-\x0D]*$'))
      or (len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) >= 10
          and len(list_distinct(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) * 100
              < 20 * len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')))
      or (regexp_matches(lower(l), '(^|[^\pL\pN_])(all rights reserved|cookie policy|privacy policy|terms of service|terms of use|accept cookies|use cookies|enable javascript|click here|sign in|log in|subscribe to our newsletter|licensed under|powered by)([^\pL\pN_]|$)')
          and (len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) <= 20
            or 100 * list_sum(list_transform(
                 regexp_extract_all(regexp_replace(lower(l), '([^\pL\pN_])', '\1\1', 'g'),
                   '(^|[^\pL\pN_])(all  rights  reserved|cookie  policy|privacy  policy|terms  of  service|terms  of  use|accept  cookies|use  cookies|enable  javascript|click  here|sign  in|log  in|subscribe  to  our  newsletter|licensed  under|powered  by)([^\pL\pN_]|$)', 2),
                 lambda x: len(string_split(x, '  '))))
               >= 20 * len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> ''))))
    )) as good
  from parts),
windows as (
  select doc_id, unnest(range(1, len(words) - 1)) as i, words from parts),
grams as (select doc_id, i, words[i] as a, words[i + 1] as b, words[i + 2] as c from windows),
often as (select *, count(*) over (partition by doc_id, a, b, c) as k from grams),
covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from often where k > 1) group by doc_id),
counted as (
  select doc_id, len(words)::bigint as n_words, length(list_reduce(list_prepend('', words), lambda x, y: x || y))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n, 0)::bigint as n_repeat_words,
    (len(lines) - len(good))::bigint as failed_lines,
    (length(regexp_replace(array_to_string(lines, ''), '[\x20\x09-\x0D]+', '', 'g'))
      - length(regexp_replace(coalesce(array_to_string(good, ''), ''), '[\x20\x09-\x0D]+', '', 'g')))::bigint as lost_chars
  from judged left join covered using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not (lost_chars * 100 > word_chars * 50) as kept,
  failed_lines, lost_chars
from counted"""
)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of all documents: counts and verdicts."""
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexicon learned from the labels outside the held-out fold, scores for all documents."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level tokens of all documents."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return sharding.kd_shards(table(spark, sf_dir, "documents"), 40)


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048).select(
        *packing.KEPT, "sequence_id", "offset"
    )


@query()
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.85 or more."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 400-byte strings that also start elsewhere."""
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


@query()
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


@query()
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the documents that are not held out."""
    return lm_scoring.language_scores(table(spark, sf_dir, "documents"))


@query()
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded: number, sum and ordered crc32 of the ids, bytes among them, and whether the text comes back."""
    return sentencepiece_lattice.piece_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All frequent words of the documents with their near words, forms and roots."""
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), damage=199)


@query(
    r"""
with parts as (
  select doc_id, row_number() over () as r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
  from documents),
windows as (
  select r, doc_id, i, array_to_string(words[i:i + 49], ' ') as w from (select r, doc_id, words, unnest(range(1, len(words) - 48)) as i from parts)),
first as (select w, min(doc_id) as least from windows group by w),
again as (select r, i from windows join first using (w) where least < doc_id),
gone as (select distinct r, p from (select r, unnest(range(i, i + 50)) as p from again)),
kept as (
  select r, string_agg(word, ' ' order by p) as t, count(*) as n
  from (select r, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from parts) anti join gone using (r, p) group by r)
select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from parts left join kept using (r)"""
)
def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of 50 words that an earlier document has."""
    return passages.without_passages(table(spark, sf_dir, "documents")).drop("kept")


@query(
    r"""
with terms as (
  select doc_id, row_number() over () as r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as own
  from documents),
totals as (select count(*)::bigint as n_docs, sum(len(own))::bigint as n_terms from terms where len(own) > 0),
asked as (
  select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
counted as (select r, doc_id, n, term, count(*)::bigint as tf from (select r, doc_id, len(own)::bigint as n, unnest(own) as term from terms) group by all),
weighted as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w from counted, totals group by term, n_docs),
scored as (
  select item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::bigint as score
  from asked join counted using (term) join weighted using (term), totals group by item_id, doc_id, r),
best as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from best where rank <= 10"""
)
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of each benchmark item."""
    return lexical.ranked(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), k=10)
