"""Move and protect whole tables with Spark.

Loads files or catalog tables into a warehouse (rejects set aside, target
replaced on request), extracts warehouse tables or query results to files, and
encrypts, decrypts and masks columns.
"""

from .functions import decrypt_columns, encrypt_columns, mask, mask_columns, read_passphrase
from .plans import LoadReport, extract, load, warehouse_for
from .spec import TableName, TransferSpec, merge_options
from .warehouse import CatalogWarehouse, JdbcWarehouse

__all__ = [
    "CatalogWarehouse", "JdbcWarehouse", "LoadReport", "TableName", "TransferSpec",
    "decrypt_columns", "encrypt_columns", "extract", "load", "mask", "mask_columns",
    "merge_options", "read_passphrase", "warehouse_for",
]
