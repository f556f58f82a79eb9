"""Training-data operators: dedup, filtering, mixing, archives and sharding.

Nothing outside this subpackage imports it.  Every operator module keeps a
general interface; :mod:`gaugeworks.llm.registry` holds the thin whole-table
queries and their SQL.
"""
