"""Raw files, the partitioned lake, and tables."""
