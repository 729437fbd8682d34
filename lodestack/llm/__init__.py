"""Operators of a training-data pipeline over tables of documents and web pages.

Nothing else in the library imports this subpackage.  ``registry`` names the
queries; the operators keep general interfaces in the other modules.
"""
