"""Operators of a training-data pipeline: sharding, token files, deduplication,
token counts, packing, decontamination, top-k search and toxicity.

Nothing outside this package imports it. Queries and their SQL are in
:mod:`chronoweave.llm.queries`.
"""
