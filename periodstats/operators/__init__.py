"""Row-level and relational operators of each layer."""
