"""Operators of a training-data pipeline over a ``documents`` table; nothing else imports this package."""
