"""Validated batch intake on Spark: read, check, split, merge and publish flat tables."""
