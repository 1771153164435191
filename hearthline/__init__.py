"""Listings-and-reviews analytics as Spark DataFrame operators.

``functions`` build columns, ``sources`` and ``sinks`` read and write tables,
``operators`` are the general table operators, and ``plans`` bind them to the
listings and reviews tables and to the job that writes the seven gold tables.
"""
