"""Training-data operators (deduplication, packing, extraction, scans) and their queries.

Nothing else in the library imports this subpackage.
"""
