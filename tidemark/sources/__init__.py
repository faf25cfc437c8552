"""Scans: landed files, catalog tables, tracked maps, file inventories."""
