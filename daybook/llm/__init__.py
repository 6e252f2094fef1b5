"""Training-data operators: one module per operator, plus their registered queries.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; the registered queries are in :mod:`daybook.llm.queries`.
"""
