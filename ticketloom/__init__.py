"""ticketloom: support-ticket analytics as Spark jobs.

Every operator takes and returns DataFrames and runs no action of its own;
only sinks, model fitting and streaming starts do.
"""

__version__ = "0.1.0"
