"""Operators of a training-data pipeline over document tables.

One module per operator; ``queries`` registers them.  Nothing outside this
package imports it, apart from the guarded import in ``__spark_entry__``.
"""
