"""The operators' queries over the supplied tables, by name."""

from tablejobs.llm.bpe import op5_bpe
from tablejobs.llm.decontamination import OP10_SQL, op10_decontamination
from tablejobs.llm.hilbert import op4_hilbert_sharding
from tablejobs.llm.jaccard import OP6_SQL, op6_jaccard
from tablejobs.llm.language_id import op7_language_id
from tablejobs.llm.lm_scoring import op1_lm_scoring
from tablejobs.llm.merkle import OP12_SQL, op12_merkle_manifest
from tablejobs.llm.periodic_runs import op11_periodic_runs
from tablejobs.llm.pivot_search import OP13_SQL, op13_pivot_search
from tablejobs.llm.quality_rules import op9_quality_rules
from tablejobs.llm.repeats import op8_suffix_repeats
from tablejobs.llm.warc import OP3_SQL, op3_warc
from tablejobs.llm.wrappers import op2_html_wrappers

QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_html_wrappers": op2_html_wrappers,
    "op3_warc": op3_warc,
    "op4_hilbert_sharding": op4_hilbert_sharding,
    "op5_bpe": op5_bpe,
    "op6_jaccard": op6_jaccard,
    "op7_language_id": op7_language_id,
    "op8_suffix_repeats": op8_suffix_repeats,
    "op9_quality_rules": op9_quality_rules,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_pivot_search": op13_pivot_search,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op3_warc": OP3_SQL,
    "op6_jaccard": OP6_SQL,
    "op10_decontamination": OP10_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_pivot_search": OP13_SQL,
}
