"""Operators for preparing training text: packing, joins on shingles, language, secrets, quality, tokens, shards."""
