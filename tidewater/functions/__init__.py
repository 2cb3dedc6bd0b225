"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""
from .rows import content_hash, literal_frame, reason_column, row_hash
from .typed import after, parse, render

__all__ = ["after", "parse", "render", "reason_column", "row_hash", "content_hash", "literal_frame"]
