"""wagerflow: betting-event analytics as plain Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark's
own expressions, so Catalyst plans it and the same code runs in batch and in
Structured Streaming.  See README.md for the module map.
"""

__version__ = "0.1.0"
