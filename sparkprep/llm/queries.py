"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from corpus_pipeline import run as pipeline
from sparkprep.llm.bpe import op10_bpe
from sparkprep.llm.byte_bpe import op11_byte_bpe
from sparkprep.llm.chat import op4_chat_formatting
from sparkprep.llm.common import Query, ship
from sparkprep.llm.decontaminate import op5_decontamination
from sparkprep.llm.line_templates import op7_line_dedup
from sparkprep.llm.max_sketch import RANKED_SEARCH_SQL, op12_ranked_search
from sparkprep.llm.passages import op3_substring_dedup
from sparkprep.llm.quality import op9_quality_rules
from sparkprep.llm.secret_scan import op8_secret_scans
from sparkprep.llm.sharding import op1_sharding
from sparkprep.llm.shingle_join import op2_ngram_jaccard_join
from sparkprep.llm.suffix_dedup import op6_suffix_array_dedup
from sparkprep.llm.word_runs import op13_periodic_runs

_OPERATORS: tuple[Query, ...] = (
    op1_sharding,
    op2_ngram_jaccard_join,
    op3_substring_dedup,
    op4_chat_formatting,
    op5_decontamination,
    op6_suffix_array_dedup,
    op7_line_dedup,
    op8_secret_scans,
    op9_quality_rules,
    op10_bpe,
    op11_byte_bpe,
    op12_ranked_search,
    op13_periodic_runs,
)


def _in_utc(query: Query) -> Query:
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {q.__name__: _in_utc(q) for q in _OPERATORS}
QUERIES["pipeline"] = _in_utc(pipeline)

ORACLE: dict[str, str] = {"op12_ranked_search": RANKED_SEARCH_SQL}
