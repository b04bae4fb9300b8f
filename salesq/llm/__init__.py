"""Operators of a training-data pipeline over documents, vectors and web pages.

One module per operator (``opN``-named queries live in ``queries``). Nothing
else in the library imports this package."""
