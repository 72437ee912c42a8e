"""Operators for training-data corpora: filtering, copies, tokens, shards."""
