"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.llm import chat, lexical, line_dedup, minhash, periodic, substring, url_filter
from meterline.llm.common import read_table
from meterline.llm.decontaminate import contaminated
from meterline.llm.packing import pack_documents
from meterline.llm.quality import quality_report
from meterline.llm.simhash import near_duplicates
from meterline.llm.token_counts import token_counts
from meterline.llm.token_files import written_documents
from meterline.llm.url_filter import Rule

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"

# The rules of the URL query.
URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def op1_chat_formatting(spark, sf_dir):
    return chat.formatted_conversations(read_table(spark, sf_dir, "conversations"))


def op2_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_best_fit_packing(spark, sf_dir):
    return pack_documents(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op4_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(read_table(spark, sf_dir, "documents"), report=True)


def op5_quality_rules(spark, sf_dir):
    return quality_report(read_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark, sf_dir):
    return substring.repeated_passages(read_table(spark, sf_dir, "documents")).drop("text_key")


def op7_token_files(spark, sf_dir):
    return written_documents(read_table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op8_benchmark_decontamination(spark, sf_dir):
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark, sf_dir):
    return token_counts(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op10_url_filters(spark, sf_dir):
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op11_periodic_runs(spark, sf_dir):
    return periodic.runs_report(periodic.planted(read_table(spark, sf_dir, "documents")))


def op12_ranked_search(spark, sf_dir):
    return lexical.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_files": op7_token_files,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_url_filters": op10_url_filters,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ranked_search": op12_ranked_search,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

# Tokenizers, zstandard and XXH64 have no SQL form: the other queries are
# tested against brute force in tests/llm.
ORACLE_SQL = {
    "op1_chat_formatting": chat.oracle_sql(),
    "op4_line_dedup": line_dedup.oracle_sql(),
    "op6_substring_dedup": substring.oracle_sql(),
    "op10_url_filters": url_filter.oracle_sql(URL_RULES),
    "op11_periodic_runs": periodic.oracle_sql(),
    "op12_ranked_search": lexical.oracle_sql(),
    "op13_minhash_near_dedup": minhash.oracle_sql(),
}
