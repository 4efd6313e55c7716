"""Column-level expressions (JVM-side built-ins only)."""

from lakemart.functions.scalar import lookup, replace_values, safe_int, safe_timestamp, share_pct
from lakemart.functions.text import ascii_fold, slug, split_options
from lakemart.functions.vocabulary import cell_tokens

__all__ = [
    "ascii_fold", "slug", "split_options",
    "lookup", "replace_values", "safe_int", "safe_timestamp", "share_pct",
    "cell_tokens",
]
