"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pricebars.llm import bpe, chat, decontam, hardneg, kdsearch, langid, licences, nearjoin, phrases, shards, substrings, suffixes, urlfilter
from pricebars.session import ensure_checkpoint_dir

_PLAIN = {
    "op1_jaccard_join": nearjoin.op1_jaccard_join,
    "op2_kdtree_topk": kdsearch.op2_kdtree_topk,
    "op3_licence_scan": licences.op3_licence_scan,
    "op4_url_filter": urlfilter.op4_url_filter,
    "op5_kdtree_shards": shards.op5_kdtree_shards,
    "op6_perspectives": chat.op6_perspectives,
    "op7_language_id": langid.op7_language_id,
    "op8_decontamination": decontam.op8_decontamination,
    "op9_bpe": bpe.op9_bpe,
    "op10_substring_dedup": substrings.op10_substring_dedup,
    "op11_collocations": phrases.op11_collocations,
    "op12_hard_negatives": hardneg.op12_hard_negatives,
    "op13_suffix_dedup": suffixes.op13_suffix_dedup,
}


def _ready(query):
    """The query with a checkpoint folder: the session's own, or one for tests."""

    def run(spark, sf_dir):
        ensure_checkpoint_dir(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _ready(query) for name, query in _PLAIN.items()}

ORACLE = {
    "op2_kdtree_topk": kdsearch.SQL,
    "op4_url_filter": urlfilter.SQL,
    "op6_perspectives": chat.SQL,
    "op8_decontamination": decontam.SQL,
    "op11_collocations": phrases.SQL,
    "op12_hard_negatives": hardneg.SQL,
}
