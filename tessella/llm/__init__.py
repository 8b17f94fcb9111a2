"""Training-data operators: quality rules, chat tool calls, deduplication, fixity,
secret scans, packing, decontamination and token files.

Nothing outside this folder imports it; ``__spark_entry__`` adds ``queries`` and
``oracle_sql`` from :mod:`tessella.llm.catalog` when the folder is there.
"""
