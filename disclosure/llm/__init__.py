"""Operators of a training-data pipeline over ``documents``, ``conversations`` and ``embeddings``.

One module per operator; ``queries`` registers them, ``text`` and ``stage`` are shared helpers.
Nothing else in the package imports this one.
"""
