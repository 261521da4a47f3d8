"""starloom: a PySpark star-schema builder for a normalised retail source.

Flattens lookups into dimensions with ordered surrogate keys, generates a
calendar, resolves keys and measures onto an order-line fact, rolls it up into
a monthly snapshot with year-to-date totals, answers a star-join report and
checks declared constraints - all as Spark DataFrame plans.
"""

__version__ = "0.1.0"
