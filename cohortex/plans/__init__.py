"""Composite jobs: feature tables (literal / fused), datasets, the whole run."""
