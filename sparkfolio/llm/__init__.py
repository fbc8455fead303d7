"""Operators for preparing training data at corpus scale.

One module per operator; ``queries`` registers the driver queries.  Nothing
outside this package imports it.
"""
