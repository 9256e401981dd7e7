"""Writers."""

from filmlake.sinks.files import (
    write_csv,
    write_json_array,
    write_json_lines,
    write_parquet,
    write_parquet_unless_empty,
)
from filmlake.sinks.jdbc import write_jdbc

__all__ = [
    "write_csv",
    "write_jdbc",
    "write_json_array",
    "write_json_lines",
    "write_parquet",
    "write_parquet_unless_empty",
]
