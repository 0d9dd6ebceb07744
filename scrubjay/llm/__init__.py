"""Operators for preparing training text: scoring, language, archives, search, packing and near-duplicates.

Nothing else in the library imports this subpackage; it may use the library's general helpers
(``sources.tables``, ``session``). Every operator takes a DataFrame and names of columns, reads only
those columns, and documents what it returns for nulls, empty texts, ties and empty tables.
"""
