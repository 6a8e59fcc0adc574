"""Reading and writing: mail directories, Parquet tables, JSON documents, scratch."""
