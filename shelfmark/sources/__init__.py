from shelfmark.sources.tables import REQUIRED_COLUMNS, Tables, store_lower_ids

__all__ = ["REQUIRED_COLUMNS", "Tables", "store_lower_ids"]
