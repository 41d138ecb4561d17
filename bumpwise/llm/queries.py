"""One query per operator; the SQL twins are in `oracles`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bumpwise.llm.bpe import op4_byte_bpe
from bumpwise.llm.ctw import op1_lm_scoring
from bumpwise.llm.embeddings import op2_embedding_dedup
from bumpwise.llm.jaccard import op5_jaccard_join
from bumpwise.llm.language import op10_language_id
from bumpwise.llm.lines import op7_line_dedup
from bumpwise.llm.mixing import op9_mixing
from bumpwise.llm.quality import OP8_SQL, op8_quality_rules
from bumpwise.llm.search import OP13_SQL, op13_ranked_search
from bumpwise.llm.sharding import op6_sharding
from bumpwise.llm.toxicity import op3_toxicity
from bumpwise.llm.trie import OP12_SQL, op12_prefix_trie
from bumpwise.llm.warc import OP11_SQL, op11_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (op1_lm_scoring, op2_embedding_dedup, op3_toxicity, op4_byte_bpe, op5_jaccard_join, op6_sharding, op7_line_dedup, op8_quality_rules, op9_mixing, op10_language_id, op11_warc, op12_prefix_trie, op13_ranked_search)
}
ORACLES: dict[str, str] = {"op8_quality_rules": OP8_SQL, "op11_warc": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_ranked_search": OP13_SQL}
