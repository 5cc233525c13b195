"""millrace: batch analytics jobs as lazy Spark DataFrame plans.

``functions``  column expressions (text, dates, numbers, JSON, rules)
``operators``  DataFrame -> DataFrame building blocks (joins, ordered-group, spans, nesting)
``sources``    scans and sinks over Parquet / CSV / catalog tables
``plans``      finished reports composed from the above
``catalog``    the reports bound to the driver's test tables, with their SQL checks
"""
