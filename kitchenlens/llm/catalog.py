"""Registered queries of this subpackage: name → callable(spark, sf_dir) → DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op10_ann
from .decontaminate import OP6_SQL, op6_decontamination
from .divergence import OP13_SQL, op13_divergence
from .langid import op4_language
from .negatives import OP11_SQL, op11_hard_negatives
from .packing import op1_packing
from .pieces import op12_pieces
from .pii import op7_pii
from .sharding import op8_sharding
from .simhash import op2_simhash
from .toxicity import op5_toxicity
from .urls import op9_url_filter
from .warc import OP3_SQL, op3_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_language": op4_language,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_sharding": op8_sharding,
    "op9_url_filter": op9_url_filter,
    "op10_ann": op10_ann,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_pieces": op12_pieces,
    "op13_divergence": op13_divergence,
}
ORACLES: dict[str, str] = {
    "op3_warc": OP3_SQL,
    "op6_decontamination": OP6_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_divergence": OP13_SQL,
}
