"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, exact_dedup, jaccard_join, sharding, suffix_dedup, vector_codes
from .chunk_codec import op7_bpe_codec
from .conversation_repair import op13_conversation_repair
from .exact_dedup import op8_exact_dedup
from .jaccard_join import op11_jaccard_join
from .language import op2_language_id
from .near_dedup import op6_near_dedup
from .neighbours import op4_nearest_neighbours
from .packing import op5_best_fit_packing
from .quality import op1_quality_classifier
from .sharding import op3_sharding
from .suffix_dedup import op9_suffix_dedup
from .token_output import op10_token_output
from .vector_codes import op12_vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_language_id": op2_language_id,
    "op3_sharding": op3_sharding,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_near_dedup": op6_near_dedup,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_token_output": op10_token_output,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op3_sharding": sharding.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op9_suffix_dedup": suffix_dedup.ORACLE,
    "op11_jaccard_join": jaccard_join.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
