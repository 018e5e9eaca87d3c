"""Registered queries of the operators, with the SQL of those that SQL can express."""

from __future__ import annotations

from tradeloom.llm.ann import ann_query
from tradeloom.llm.base import prepare_llm
from tradeloom.llm.embedding_dedup import EMBEDDING_SQL, embedding_query
from tradeloom.llm.fill_in_middle import FIM_SQL, fim_query
from tradeloom.llm.hard_negatives import NEGATIVES_SQL, negatives_query
from tradeloom.llm.language_id import language_query
from tradeloom.llm.lm_scoring import lm_query
from tradeloom.llm.mixing import MIXING_SQL, mixing_query
from tradeloom.llm.pii import pii_query
from tradeloom.llm.quality import quality_query
from tradeloom.llm.secret_scan import secrets_query
from tradeloom.llm.sentencepiece_codec import codec_query
from tradeloom.llm.simhash import simhash_query
from tradeloom.llm.weak_rules import rules_query

QUERIES = {
    "op1_lm_scoring": lm_query,
    "op2_simhash": simhash_query,
    "op3_sentencepiece": codec_query,
    "op4_pii": pii_query,
    "op5_language_id": language_query,
    "op6_quality": quality_query,
    "op7_embedding_dedup": embedding_query,
    "op8_nearest_neighbours": ann_query,
    "op9_secrets": secrets_query,
    "op10_mixing": mixing_query,
    "op11_fill_in_middle": fim_query,
    "op12_hard_negatives": negatives_query,
    "op13_quality_rules": rules_query,
}


def llm_queries():
    def prepared(query):
        return lambda spark, folder: query(prepare_llm(spark), folder)

    return {name: prepared(query) for name, query in QUERIES.items()}


def llm_oracles():
    return {"op7_embedding_dedup": EMBEDDING_SQL, "op10_mixing": MIXING_SQL,
            "op11_fill_in_middle": FIM_SQL, "op12_hard_negatives": NEGATIVES_SQL}
