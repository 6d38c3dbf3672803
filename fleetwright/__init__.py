"""Device-fleet and firmware-update analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames; nothing here runs a
job unless its docstring says so.
"""
