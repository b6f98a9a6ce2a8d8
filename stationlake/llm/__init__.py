"""Operators that prepare text corpora and vectors for training; nothing else imports this."""
