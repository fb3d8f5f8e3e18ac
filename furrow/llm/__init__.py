"""Training-data operators: ten corpus operations and the helpers they share.

Nothing else in the library imports this package. Each module holds one
operator with its general interface; ``queries.py`` binds them to the given
tables.
"""
