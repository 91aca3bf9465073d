from .files import extract_files
from .tables import load_table, replace_and_load, replace_target

__all__ = ["extract_files", "load_table", "replace_and_load", "replace_target"]
