"""Clustering, projection and classification on MLlib."""
