"""Jobs that are run by themselves: python -m jobs.chunk_store, python -m jobs.keyword_board."""
