"""Table sinks and the one-computation, many-sinks fan-out."""

from disclosure.sinks.tables import (
    append_table,
    clear_and_append,
    connector_write,
    create_if_missing,
    fan_out,
    overwrite_table,
    replace_table,
    store_column_types,
    validate_table_name,
)

__all__ = [
    "append_table",
    "clear_and_append",
    "connector_write",
    "create_if_missing",
    "fan_out",
    "overwrite_table",
    "replace_table",
    "store_column_types",
    "validate_table_name",
]
