"""Incremental work: what is fresh, and files that arrive while the job runs."""
