"""A Spark lakehouse pipeline for trees of nested security-advisory records."""
