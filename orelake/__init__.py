"""Orelake: layered (bronze, silver, gold) data work as plain Spark jobs.

Every operator is a function from DataFrame to DataFrame.  Nothing holds a
global session, and nothing but fixed-size results reaches the driver.
"""
