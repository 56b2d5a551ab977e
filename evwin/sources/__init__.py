"""Sources: raw-table schemas, parquet readers/writers, landed payloads, and
the derivation of raw tables from the TPC-H-ish test tables."""
