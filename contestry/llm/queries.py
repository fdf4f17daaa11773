"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from . import decontaminate, filter_audit, hard_negatives, language_model, licences, mixing, ngram_join, quality, sharding, surrogates, token_counts, toxicity, warc
from .common import table

QUERIES: dict = {}
ORACLE: dict = {}
#: What the bench times.
HEADLINE = ["op1_pareto_mix", "op2_licence_scan", "op6_quality_rules", "op7_sharding", "op8_decontamination", "op10_warc"]


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op7_sharding(spark, sf_dir):
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


@query
def op1_pareto_mix(spark, sf_dir):
    return mixing.mix_words(table(spark, sf_dir, "documents"))


ORACLE["op1_pareto_mix"] = mixing.SQL


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op8_decontamination"] = decontaminate.SQL


@query
def op10_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLE["op10_warc"] = warc.SQL


@query
def op6_quality_rules(spark, sf_dir):
    return quality.quality_digest(table(spark, sf_dir, "documents"))


ORACLE["op6_quality_rules"] = quality.SQL


@query
def op5_ngram_jaccard(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


ORACLE["op5_ngram_jaccard"] = ngram_join.SQL


@query
def op3_language_model(spark, sf_dir):
    return language_model.score_documents(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline


@query
def op2_licence_scan(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


ORACLE["op2_licence_scan"] = licences.oracle_sql()


@query
def op9_pii_surrogates(spark, sf_dir):
    return surrogates.surrogate_texts(table(spark, sf_dir, "documents"))


@query
def op13_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(token_counts.FILE))


@query
def op12_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = filter_audit.SQL


@query
def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE["op11_hard_negatives"] = hard_negatives.SQL
