"""Sources and sinks: raw trip files, zone lookup, partitioned parquet, JDBC."""
