"""Writers: layered Parquet, CSV exports, catalog registration."""

from lakemart.sinks.catalog import LayerTypeError, register_layer, register_marts, register_tables, run_sql
from lakemart.sinks.files import (export_csv, write_column_map, write_edition, write_layer,
                                  write_partitioned)
# ``publish`` itself is taken from its module, which has the same name
from lakemart.sinks.publish import PublishError, expire, read_published, register_published, versions

__all__ = ["write_layer", "write_partitioned", "write_edition", "write_column_map",
           "export_csv", "LayerTypeError", "register_layer", "register_marts",
           "register_tables", "run_sql",
           "PublishError", "expire", "read_published", "register_published", "versions"]
