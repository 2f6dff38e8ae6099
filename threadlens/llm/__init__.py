"""Operators for training-data preparation on the tables of web text."""
