"""mailgauge: analytics over large e-mail corpora as plain PySpark jobs.

Every operator is a function from DataFrame to DataFrame (or from Column to
Column).  The session is always passed in and no path is hard-coded.
"""
