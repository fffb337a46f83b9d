"""Composed plans: the end-to-end pipeline, the allotment projection and the registered queries."""
