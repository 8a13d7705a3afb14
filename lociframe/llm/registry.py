"""The queries of this subpackage for ``__spark_entry__.py``, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import op13_byte_bpe
from .divergence import op12_source_divergence, op12_sql
from .embedding_dedup import op7_embedding_dedup
from .exact_dedup import op3_exact_dedup, op3_sql
from .mixing import op4_mix_sources
from .packing import op1_best_fit_packing
from .pii import op10_pii
from .quality import op9_quality
from .sharding import op5_sharding
from .simhash import op6_simhash
from .token_files import op2_token_files
from .toxicity import op8_toxicity
from .variants import op11_spelling_variants, op11_sql

_ALL = (op1_best_fit_packing, op2_token_files, op3_exact_dedup, op4_mix_sources, op5_sharding, op6_simhash, op7_embedding_dedup, op8_toxicity, op9_quality, op10_pii, op11_spelling_variants, op12_source_divergence, op13_byte_bpe)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
SQL: dict[str, str] = {"op3_exact_dedup": op3_sql(), "op11_spelling_variants": op11_sql(), "op12_source_divergence": op12_sql()}
