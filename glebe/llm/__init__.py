"""Operators of a training-data pipeline over ``documents``, ``pages``, ``benchmark`` and ``labels``.

Nothing else in the library imports this package; its queries and SQL are in
:mod:`glebe.llm.queries`.
"""
