"""The queries of this subpackage; ORACLE holds SQL where it can express one."""

from __future__ import annotations

from . import license_scan
from .byte_bpe import op1_byte_bpe
from .embedding_dedup import op8_embedding_dedup
from .license_scan import op10_license_scan
from .packing import op5_best_fit
from .quality import op6_quality
from .simhash import op3_simhash
from .suffix_dedup import op7_suffix_dedup
from .token_files import op4_token_files
from .toxicity import op9_toxicity
from .url_filter import op2_url_filter

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_url_filter": op2_url_filter,
    "op3_simhash": op3_simhash,
    "op4_token_files": op4_token_files,
    "op5_best_fit": op5_best_fit,
    "op6_quality": op6_quality,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_license_scan": op10_license_scan,
}
ORACLE: dict[str, str] = {"op10_license_scan": license_scan.ORACLE_SQL}
