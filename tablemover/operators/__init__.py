"""R1-R3 and small helpers."""
from .rejects import conversion_split, duplicate_split, matched_columns, prepare_reject_tables

__all__ = ["conversion_split", "duplicate_split", "held_split", "matched_columns", "prepare_reject_tables"]
