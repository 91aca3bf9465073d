from .files import read_avro, read_delimited, read_files, spark_format
from .tables import read_catalog_table, read_query, read_table_split

__all__ = ["read_avro", "read_delimited", "read_files", "spark_format",
           "read_catalog_table", "read_query", "read_table_split"]
