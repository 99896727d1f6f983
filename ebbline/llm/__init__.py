"""Operators for preparing training text: deduplication, filtering, tokenization. Nothing else imports this package."""
