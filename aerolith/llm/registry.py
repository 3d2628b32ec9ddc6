"""The queries of this subpackage and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

from .covertree import op7_covertree
from .html import op5_html
from .jaccard import OP9_SQL, op9_jaccard
from .language import op8_language
from .linededup import op1_lines
from .merklelog import OP12_SQL, op12_manifest
from .mixing import op2_mixing
from .packing import op4_packing
from .periodicity import op13_runs
from .phraseindex import OP11_SQL, op11_contamination
from .secrets import op3_secrets
from .urlfilter import OP6_SQL, op6_urls
from .winnowing import op10_winnowing

QUERIES = {
    "op1_lines": op1_lines,
    "op2_mixing": op2_mixing,
    "op3_secrets": op3_secrets,
    "op4_packing": op4_packing,
    "op5_html": op5_html,
    "op6_urls": op6_urls,
    "op7_covertree": op7_covertree,
    "op8_language": op8_language,
    "op9_jaccard": op9_jaccard,
    "op10_winnowing": op10_winnowing,
    "op11_contamination": op11_contamination,
    "op12_manifest": op12_manifest,
    "op13_runs": op13_runs,
}
ORACLE_SQL: dict[str, str] = {"op6_urls": OP6_SQL, "op9_jaccard": OP9_SQL, "op11_contamination": OP11_SQL, "op12_manifest": OP12_SQL}
