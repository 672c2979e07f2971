"""History-keeping warehouse tables (hubs, links, satellites, point-in-time
tables and type-2 marts) built from change events with plain Spark DataFrames.

The pure operators take and return DataFrames and read no clock; storage and
load order live in ``stratakeep.plans.warehouse``.
"""

__version__ = "0.1.0"
