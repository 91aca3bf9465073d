from .transfer import LoadReport, decrypt_value, extract, load, spec_from_properties, warehouse_for

__all__ = ["LoadReport", "decrypt_value", "extract", "load", "spec_from_properties", "warehouse_for"]
