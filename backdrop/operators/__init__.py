"""Frame operators (Arrow batches) and relational operators (DataFrame API)."""
