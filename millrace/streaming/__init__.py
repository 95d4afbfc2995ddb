"""Running programs on streams and publishing their results."""
