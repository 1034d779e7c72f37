"""Card-transaction fraud analytics as Spark jobs.

Every operator takes and returns DataFrames.  Only the command line
(``python -m cardwatch``) starts a session.
"""
