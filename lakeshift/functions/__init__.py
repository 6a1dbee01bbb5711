"""Column builders: read-type predicates and text helpers."""

from lakeshift.functions.predicates import ReadSpec, apply_read_type, read_filter, resolve_read_spec, resolve_window
from lakeshift.functions.text import as_text, pad_left, sanitize_columns, sanitize_name, strip_whitespace

__all__ = [
    "ReadSpec",
    "apply_read_type",
    "as_text",
    "pad_left",
    "read_filter",
    "resolve_read_spec",
    "resolve_window",
    "sanitize_columns",
    "sanitize_name",
    "strip_whitespace",
]
