"""The queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from tracelake.llm.byte_bpe import op4_byte_bpe
from tracelake.llm.decontam import op6_decontam
from tracelake.llm.fill_middle import OP11_SQL, op11_fill_middle
from tracelake.llm.fuzzy_lines import op10_fuzzy_lines
from tracelake.llm.main_text import op9_main_text
from tracelake.llm.packing import op13_packing
from tracelake.llm.pii import op2_pii
from tracelake.llm.quality import op5_quality
from tracelake.llm.repeats import op8_repeats
from tracelake.llm.simhash import op7_simhash
from tracelake.llm.spelling import op12_spelling
from tracelake.llm.token_counts import op3_token_counts
from tracelake.llm.token_files import op1_token_files
from tracelake.shipping import ship

QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_pii, op3_token_counts, op4_byte_bpe, op5_quality, op6_decontam, op7_simhash, op8_repeats, op9_main_text, op10_fuzzy_lines,
    op11_fill_middle, op12_spelling, op13_packing)}


def queries() -> dict:
    return {name: _shipped(make) for name, make in QUERIES.items()}


def _shipped(make):
    def run(spark, sf):
        ship(spark)
        return make(spark, sf)

    return run


def oracle_sql() -> dict[str, str]:
    return {"op11_fill_middle": OP11_SQL}
