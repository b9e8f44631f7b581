"""The operators as queries over the given tables, and the SQL that some must equal."""

from __future__ import annotations

from lendmart.llm.audit import OP11_SQL, op11_failing_ids
from lendmart.llm.chat import op7_content_parts
from lendmart.llm.decontaminate import op9_winnowing
from lendmart.llm.divergence import OP13_SQL, op13_gustavson
from lendmart.llm.jaccard import op6_metric_join
from lendmart.llm.langid import op5_mixture
from lendmart.llm.lines import op1_log_templates
from lendmart.llm.lm import op2_deleted_interpolation
from lendmart.llm.packing import op3_least_squares
from lendmart.llm.pii import op4_bootstrapped_contexts
from lendmart.llm.sharding import op10_histogram_sort
from lendmart.llm.topk import op8_histogram_selection
from lendmart.llm.wrappers import OP12_SQL, op12_wrappers

QUERIES = {f.__name__: f for f in (
    op1_log_templates, op2_deleted_interpolation, op3_least_squares,
    op4_bootstrapped_contexts, op5_mixture, op6_metric_join, op7_content_parts,
    op8_histogram_selection, op9_winnowing, op10_histogram_sort,
    op11_failing_ids, op12_wrappers, op13_gustavson)}
ORACLES: dict[str, str] = {"op11_failing_ids": OP11_SQL, "op12_wrappers": OP12_SQL,
                           "op13_gustavson": OP13_SQL}
