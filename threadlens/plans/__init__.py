"""Registered queries over the test tables and the end-to-end workflows."""
