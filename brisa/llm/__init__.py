"""Operators for training-data pipelines over documents and conversations; nothing else imports this subpackage."""
