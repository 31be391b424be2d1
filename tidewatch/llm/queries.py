"""Queries and SQL of the training-data operators, for __spark_entry__."""

from __future__ import annotations

from .decontamination import op2_string_tiling
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .html_extract import op4_html_extract
from .language_id import op8_language_id
from .mixing import op5_block_mix
from .near_dedup import op3_order_minhash
from .pii import op7_pii_crf
from .quality import op6_quality_qda
from .sharding import op10_stratified_shards
from .url_filter import op1_url_filter

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_string_tiling": op2_string_tiling,
    "op3_order_minhash": op3_order_minhash,
    "op4_html_extract": op4_html_extract,
    "op5_block_mix": op5_block_mix,
    "op6_quality_qda": op6_quality_qda,
    "op7_pii_crf": op7_pii_crf,
    "op8_language_id": op8_language_id,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_stratified_shards": op10_stratified_shards,
}
ORACLES = {"op9_exact_dedup": OP9_SQL}
