"""Writing: Parquet datasets and tables behind JDBC."""
