"""DataFrame -> DataFrame operators (chain them with ``df.transform``)."""

from lakemart.operators.distinct_state import (DistinctStore, distinct_state, merge_states,
                                               number_tokens, roll_up, state_counts, state_shares)
from lakemart.operators.frequent import frequent_values
from lakemart.operators.lineage import add_lineage
from lakemart.operators.marts import (Dimension, base_projection, count_mart, count_marts,
                                      distinct_mart, group_totals, long_format, mart_names,
                                      order_mart, share_mart, split_count_marts)
from lakemart.operators.multiselect import (VocabularyError, discover_and_validate,
                                            discover_vocabulary, explode_by_vocabulary,
                                            explode_discovered, explode_options, invalid_cells,
                                            validate_vocabulary, with_discovered_tokens, with_tokens)
from lakemart.operators.names import (column_map_frame, dedupe_names, sanitize_columns,
                                      sanitize_name)
from lakemart.operators.quality import (compare_contents, duplicate_key_count, duplicate_keys,
                                        invalid_rows, null_overall, null_profile, rows_per_group,
                                        top_k, value_counts, write_and_reconcile, write_and_verify)
from lakemart.operators.standardize import (recode_boolean, recode_values, typed_columns,
                                            unmapped_report)
from lakemart.operators.unify import (check_dictionary, dictionary_coverage, dictionary_long,
                                      mapping_for, select_by_dictionary, union_editions)

__all__ = [name for name in dir() if not name.startswith("_")]
