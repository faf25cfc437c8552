"""Writers: partitioned files, record exports, catalog tables."""
