"""Tables in and out: JDBC databases and Parquet layers."""
