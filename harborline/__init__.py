"""harborline: customer and commerce data operators for Apache Spark.

Sub-packages
------------
sources     readers: change records, vendor files, typed text lines
sinks       writers: partition replacement, audit and error tables, splits
functions   column expressions: text, dates, geo, hashing, JSON documents
operators   DataFrame -> DataFrame building blocks: latest, as-of, SCD2, merge
streaming   Structured Streaming versions of the ingestion and alert jobs
plans       whole jobs composed from the blocks above
catalog     every job bound to the sample tables, with an equivalent SQL text
"""
