"""millrace: verbatim semi-structured records to typed, reviewed, versioned tables, on Spark.

Nothing in this package imports ``millrace.llm``; that subpackage is optional.
"""
