"""The registered queries: each operator over the whole of its table."""

from __future__ import annotations

from formline.llm import alignment, language, mixing, packing, pii, quality, rules, search, secrets, setsketch, toxicity, tries, vectors
from formline.llm.common import documents, table
from formline.llm.registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]


@query("op8_setsketch_near_duplicates")
def op8(spark, sf_dir):
    return setsketch.near_duplicates(documents(spark, sf_dir))


@query("op4_best_fit_packing")
def op4(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir))


@query("op9_mix_sources")
def op9(spark, sf_dir):
    return mixing.taken_words(documents(spark, sf_dir))


@query("op1_secret_scan")
def op1(spark, sf_dir):
    return secrets.scan(documents(spark, sf_dir))


@query("op10_quality_pairs")
def op10(spark, sf_dir):
    return quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op2_hyperdimensional_language")
def op2(spark, sf_dir):
    return language.identify(documents(spark, sf_dir))


@query("op3_cross_polytope_near_duplicates")
def op3(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op7_adaptive_quality_rules")
def op7(spark, sf_dir):
    return rules.judge(documents(spark, sf_dir))


@query("op5_noisy_or_toxicity")
def op5(spark, sf_dir):
    return toxicity.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op6_semi_markov_personal_data")
def op6(spark, sf_dir):
    return pii.detect(documents(spark, sf_dir))


@query("op11_exact_text_alignment")
def op11(spark, sf_dir):
    return alignment.align_documents(documents(spark, sf_dir))


@query("op12_ball_tree_search")
def op12(spark, sf_dir):
    return search.top_products(table(spark, sf_dir, "embeddings"))


@query("op13_conversation_trie")
def op13(spark, sf_dir):
    return tries.prefix_trie(table(spark, sf_dir, "conversations"))
