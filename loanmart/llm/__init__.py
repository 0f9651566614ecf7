"""Operators for preparing training data: near copies, quality, licenses, personal data, mixing, leaks."""
