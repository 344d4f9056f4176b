"""Training-data operators: deduplication, language, toxicity, mixing, tokenising and packing.

Each module holds one operator with its own general interface; :mod:`tabsift.llm.queries` registers the
thin ``opN_*`` queries.  Nothing else in the library imports this subpackage.
"""
