"""Behaviour-log analytics as plain Spark DataFrame transformations.

Operators take a behaviour log (one row per view, cart, favourite or buy) and
return a lazy DataFrame.  See ``footfall.sources`` for how logs are read and
``footfall.plans`` for the catalogue of named queries.
"""
