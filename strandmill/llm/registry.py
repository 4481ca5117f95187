"""Queries of this subpackage, and their SQL."""

from __future__ import annotations

from strandmill.llm.decontamination import OP7_SQL, op7_decontamination
from strandmill.llm.linededup import op6_line_dedup
from strandmill.llm.media import op10_media
from strandmill.llm.mixture import OP12_SQL, op12_mixture
from strandmill.llm.packing import op9_packing
from strandmill.llm.pii import op4_pii
from strandmill.llm.quality import op3_quality
from strandmill.llm.resample import OP11_SQL, op11_resample
from strandmill.llm.setjoin import OP5_SQL, op5_ngram_jaccard
from strandmill.llm.sharding import op8_sharding
from strandmill.llm.toxicity import op2_toxicity
from strandmill.llm.urls import OP1_SQL, op1_url_filters
from strandmill.llm.vectorcodes import op13_vector_codes

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_pii": op4_pii,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
    "op10_media": op10_media,
    "op11_resample": op11_resample,
    "op12_mixture": op12_mixture,
    "op13_vector_codes": op13_vector_codes,
}
ORACLE_SQL = {"op1_url_filters": OP1_SQL, "op5_ngram_jaccard": OP5_SQL, "op7_decontamination": OP7_SQL, "op11_resample": OP11_SQL, "op12_mixture": OP12_SQL}
