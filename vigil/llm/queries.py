"""The contract queries of the pipeline operators and their oracle SQL."""

from __future__ import annotations

from vigil.llm import decontam, html_extract, language, mixing, periodic, pieces, prefix_trie, quality, setjoin, sharding, substrings, toxicity, url_filter
from vigil.llm.common import table


def op1_decontamination(spark, sf_dir):
    """Occurrences of benchmark windows in all documents."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("k")


def op2_language_id(spark, sf_dir):
    """Predicted language of all documents."""
    return language.language_report(table(spark, sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    """Toxicity score of all documents."""
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark, sf_dir):
    """All documents without passages that an earlier document has."""
    return substrings.repeats_report(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark, sf_dir):
    """Rule bitmask ledger over all documents under the current policy."""
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark, sf_dir):
    """Main text of all pages."""
    return html_extract.extraction_report(table(spark, sf_dir, "pages"))


def op7_source_mixing(spark, sf_dir):
    """Mix of all documents at 150% of their size, by source targets."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_url_filter(spark, sf_dir):
    """Verdict on every page url."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), url_filter.RULES)


def op9_sharding(spark, sf_dir):
    """All documents shuffled into 24 shards of equal counts."""
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark, sf_dir):
    """Components of documents whose shingle sets link at 0.9."""
    return setjoin.jaccard_components(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of all conversations."""
    return prefix_trie.trie_report(table(spark, sf_dir, "conversations"))


def op12_sentencepiece(spark, sf_dir):
    """All documents encoded by the public 32k model, and decoded again."""
    return pieces.encoding_report(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of words in all documents."""
    return periodic.runs_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_language_id, op3_toxicity, op4_substring_dedup, op5_quality_rules, op6_html_extraction, op7_source_mixing, op8_url_filter, op9_sharding,
                                    op10_jaccard_join, op11_prefix_trie, op12_sentencepiece, op13_periodic_runs)}

ORACLE = {"op1_decontamination": decontam.DECONTAM_SQL, "op4_substring_dedup": substrings.SUBSTRING_SQL, "op5_quality_rules": quality.QUALITY_SQL, "op7_source_mixing": mixing.MIX_SQL,
          "op8_url_filter": url_filter.URL_SQL, "op10_jaccard_join": setjoin.JACCARD_SQL, "op11_prefix_trie": prefix_trie.TRIE_SQL}
