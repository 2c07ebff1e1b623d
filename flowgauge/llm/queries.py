"""All named queries of this subpackage."""

from flowgauge.llm import delta_rollups, histogram_sort, katz_backoff, merge_path, page_differencing, perplexity_bands, positional_index, random_indexing, rank_queue_bpe, simhash_bktree, super_kmers, target_alignment, turn_rendering  # noqa: F401
from flowgauge.llm.entry import QUERIES

__all__ = ["QUERIES"]
