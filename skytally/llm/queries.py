"""The subpackage's registered queries and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from skytally.llm.common import Query
from skytally.llm.op1_dartminhash import OP1_SQL, op1_dartminhash
from skytally.llm.op2_mixing import op2_mixing
from skytally.llm.op3_embeddings import OP3_SQL, op3_embeddings
from skytally.llm.op4_substrings import OP4_SQL, op4_substrings
from skytally.llm.op5_pages import op5_pages
from skytally.llm.op6_packing import op6_packing
from skytally.llm.op7_language import op7_language
from skytally.llm.op8_spans import op8_spans
from skytally.llm.op9_sharding import op9_sharding
from skytally.llm.op10_exact_dedup import OP10_SQL, op10_exact_dedup
from skytally.llm.op11_alignment import op11_alignment
from skytally.llm.op12_rules import OP12_SQL, op12_rules
from skytally.llm.op13_phrases import OP13_SQL, op13_phrases


def queries() -> dict[str, Query]:
    return {
        "op1_dartminhash": op1_dartminhash,
        "op2_mixing": op2_mixing,
        "op3_embeddings": op3_embeddings,
        "op4_substrings": op4_substrings,
        "op5_pages": op5_pages,
        "op6_packing": op6_packing,
        "op7_language": op7_language,
        "op8_spans": op8_spans,
        "op9_sharding": op9_sharding,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_alignment": op11_alignment,
        "op12_rules": op12_rules,
        "op13_phrases": op13_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_dartminhash": OP1_SQL,
        "op3_embeddings": OP3_SQL,
        "op4_substrings": OP4_SQL,
        "op10_exact_dedup": OP10_SQL,
        "op12_rules": OP12_SQL,
        "op13_phrases": OP13_SQL,
    }
