"""SQL twins of the queries, for checking results on another engine."""
