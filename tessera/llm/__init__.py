"""Operators of a training-data pipeline, expressed as Spark jobs.

Ten operators, one module each (``op1`` .. ``op10`` are registered in
``catalog``). Nothing outside this subpackage imports it.
"""
