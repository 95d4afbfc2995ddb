"""Column-level building blocks: decoding, encoding and scalar rules."""
