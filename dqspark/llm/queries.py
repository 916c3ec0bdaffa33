"""The queries of this subpackage, by name, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import ship
from .ann import op6_nearest_neighbours
from .exact_dedup import OP10_SQL, op10_exact_dedup
from .lang_id import op2_language_id
from .lm_lattice import op1_lattice_score
from .ngram_join import OP8_SQL, op8_ngram_jaccard
from .packing import op4_best_fit_packing
from .phrase_mining import OP12_SQL, op12_phrase_mining
from .quality_ratio import op11_quality_ratio
from .secrets import op9_secret_scan
from .toxicity import op5_toxicity
from .sp_codec import op3_sentencepiece
from .token_alignment import op13_token_alignment
from .token_store import op7_token_store

_QUERIES = [op1_lattice_score, op2_language_id, op3_sentencepiece, op4_best_fit_packing, op5_toxicity, op6_nearest_neighbours, op7_token_store, op8_ngram_jaccard, op9_secret_scan, op10_exact_dedup,
            op11_quality_ratio, op12_phrase_mining, op13_token_alignment]


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    return run


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: _shipped(fn) for fn in _QUERIES}


def llm_oracle_sql() -> dict[str, str]:
    return {"op8_ngram_jaccard": OP8_SQL, "op10_exact_dedup": OP10_SQL, "op12_phrase_mining": OP12_SQL}
