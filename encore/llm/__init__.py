"""Training-data operators: cleaning, deduplication, packing, tokens, classifiers, search.

Nothing else in the library imports this package. ``encore.llm.catalog`` registers a query for
each operator, applied to its whole table.
"""
