"""Shop analytics on Spark.

Turns daily snapshots of a web shop's entity / attribute / value tables into
reporting tables (orders, order items, customers, addresses, products, stock,
campaign trackings) with DataFrame operators.  Every operator is a
``DataFrame -> DataFrame`` function; nothing runs an action except the sinks.
"""

__all__ = ["session"]
