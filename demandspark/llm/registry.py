"""Queries of the text operators: name -> (Spark query, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandspark.llm.op1_simhash import op1_simhash
from demandspark.llm.op10_quality import op10_quality
from demandspark.llm.op11_trie import op11_trie
from demandspark.llm.op12_warc import op12_warc
from demandspark.llm.op13_repair import op13_repair
from demandspark.llm.op8_embeddings import OP8_SQL, op8_embeddings
from demandspark.llm.op9_decontamination import op9_decontamination
from demandspark.llm.op5_licenses import op5_licenses
from demandspark.llm.op6_html import op6_html
from demandspark.llm.op2_pii import op2_pii
from demandspark.llm.op3_substrings import op3_substrings
from demandspark.llm.op4_sharding import op4_sharding
from demandspark.llm.op7_packing import op7_packing

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_simhash": (op1_simhash, None),
    "op2_pii": (op2_pii, None),
    "op3_substrings": (op3_substrings, None),
    "op4_sharding": (op4_sharding, None),
    "op5_licenses": (op5_licenses, None),
    "op6_html": (op6_html, None),
    "op7_packing": (op7_packing, None),
    "op8_embeddings": (op8_embeddings, OP8_SQL),
    "op9_decontamination": (op9_decontamination, None),
    "op10_quality": (op10_quality, None),
    "op11_trie": (op11_trie, None),
    "op12_warc": (op12_warc, None),
    "op13_repair": (op13_repair, None),
}
