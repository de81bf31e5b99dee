"""Daily jobs: read, compute, gate, write."""
