"""All queries of this subpackage."""

from pagemill.llm import best_fit, block_naming, centroid_lists, count_tree, line_cleaning, phrase_growth, posting_lists, prefix_counts, rule_ensemble, sampled_pieces  # noqa: F401
from pagemill.llm import suffix_trees, text_convolution, warc_index  # noqa: F401
from pagemill.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
