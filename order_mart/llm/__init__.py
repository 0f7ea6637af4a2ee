"""Training-data operators: tokenising, filtering, deduplication, packing.

Nothing else in the package imports this subpackage.  Every operator takes a
DataFrame of documents (or pages, conversations) and returns a DataFrame.
"""
