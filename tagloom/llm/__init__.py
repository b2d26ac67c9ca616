"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; only general helpers
(``tagloom.session``) are imported from it. One module holds one operator.
"""
