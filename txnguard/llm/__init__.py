"""Operators for preparing training text at corpus scale.

Nothing else in the package imports this subpackage; ``queries.py`` holds the
registered queries and ``oracle.py`` their SQL twins.
"""
