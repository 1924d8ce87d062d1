"""Training-data operators: quality, deduplication, decontamination, tokenising, extraction.

Nothing else in the library imports this subpackage.  ``registry`` lists its queries,
``oracle`` the DuckDB SQL of those that SQL can express.
"""
