"""Queries of this package by name, and their DuckDB twins where SQL can
express them."""

from __future__ import annotations

from tramline.llm.bpe import op6_bpe
from tramline.llm.chat_format import OP10_SQL, op10_chat_format
from tramline.llm.common import Builder
from tramline.llm.compression_bands import op1_compression_bands
from tramline.llm.decontaminate import op2_decontaminate
from tramline.llm.jaccard_join import op8_jaccard_join
from tramline.llm.language_id import op7_language_id
from tramline.llm.license_scan import op12_license_scan
from tramline.llm.line_dedup import op9_line_dedup
from tramline.llm.quality_trees import op3_quality_trees
from tramline.llm.ranked_search import OP11_SQL, op11_ranked_search
from tramline.llm.repeats import op4_repeats
from tramline.llm.source_audit import OP13_SQL, op13_source_audit
from tramline.llm.warc_zip import OP5_SQL, op5_warc_zip

QUERIES: dict[str, Builder] = {
    "op1_compression_bands": op1_compression_bands,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality_trees": op3_quality_trees,
    "op4_repeats": op4_repeats,
    "op5_warc_zip": op5_warc_zip,
    "op6_bpe": op6_bpe,
    "op7_language_id": op7_language_id,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_ranked_search": op11_ranked_search,
    "op12_license_scan": op12_license_scan,
    "op13_source_audit": op13_source_audit,
}

SQL: dict[str, str] = {
    "op5_warc_zip": OP5_SQL,
    "op10_chat_format": OP10_SQL,
    "op11_ranked_search": OP11_SQL,
    "op13_source_audit": OP13_SQL,
}
