"""Training-data operators (dedup, search, quality, PII, packing, BPE) as Spark jobs.

Nothing else in the library imports this subpackage; ``llm.queries`` holds its
registered queries and their SQL.
"""
