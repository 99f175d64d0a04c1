"""Operators of a training-data pipeline. One module per operator; ``queries``
holds the registered queries and their SQL."""
