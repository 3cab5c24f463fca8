"""Operators of a training-data pipeline. Nothing else in the package imports this subpackage.

``catalog`` holds the registered queries; the operators are plain modules beside it.
"""
