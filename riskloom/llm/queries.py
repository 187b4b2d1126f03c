"""The registered queries of this subpackage: each applies its operator to the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.decontamination import CONTAINED_SQL, contaminated
from riskloom.llm.html_text import main_texts
from riskloom.llm.mixing import label_domains, mix
from riskloom.llm.near_dedup import NEAR_SQL, near_duplicates
from riskloom.llm.pii import find_personal_data
from riskloom.llm.preferences import ECHO_SQL, echo_pairs, preference_pairs
from riskloom.llm.prefix_trie import TRIE_SQL, branched_trie
from riskloom.llm.pseudo_likelihood import pseudo_likelihood
from riskloom.llm.quality_cnn import quality_scores
from riskloom.llm.quality_rules import quality_rules
from riskloom.llm.repeated_passages import PASSAGES_SQL, passage_digests, without_repeats
from riskloom.llm.repetition_runs import run_digests, seeded_rewrite, word_runs
from riskloom.llm.token_counts import token_counts

#: Folder of the public tokenizer files.
TOKENIZERS = "/opt/tokenizers"


def op1_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_masked_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def op3_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op4_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_pairs(echo_pairs(table(spark, sf_dir, "conversations")))


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, label_domains(docs, table(spark, sf_dir, "labels")))


def op6_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op7_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(word_runs(table(spark, sf_dir, "documents"), seeded_rewrite))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return branched_trie(table(spark, sf_dir, "conversations"))


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_digests(without_repeats(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_containment_search, op2_masked_likelihood, op3_boosted_pii, op4_preference_pairs, op5_soft_mixing, op6_wrapper_text, op7_minmax_dedup, op8_token_counts, op9_byte_cnn, op10_quality_rules, op11_word_runs, op12_prefix_trie, op13_repeated_passages)
}
ORACLES: dict[str, str] = {
    "op1_containment_search": CONTAINED_SQL,
    "op4_preference_pairs": ECHO_SQL,
    "op7_minmax_dedup": NEAR_SQL,
    "op12_prefix_trie": TRIE_SQL,
    "op13_repeated_passages": PASSAGES_SQL,
}
