"""Operators that prepare training data for language models, from page archives to token ids."""
