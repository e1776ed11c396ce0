"""Training-data operators: ten numbered operators and their registered queries.

Nothing else in the library imports this subpackage. ``queries.REGISTRY`` and
``queries.ORACLE`` hold what ``__spark_entry__`` registers.
"""
