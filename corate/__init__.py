"""corate: item-to-item collaborative filtering expressed as Spark DataFrame jobs.

Sub-packages:

* ``sources``   - readers for item catalogs, rating logs, similarity text and packed rows
* ``sinks``     - table, text and CSV writers (overwrite / append / run-stamped)
* ``functions`` - Column expressions (Java-style int truncation, half-star weights, ...)
* ``operators`` - relational building blocks (dedupe, catalog filters, co-rating join,
  pair statistics, cosine similarity, sparse rows, scoring and top-k)
* ``plans``     - skew handling, size-checked broadcasts and the composed jobs
* ``streaming`` - incremental rating ingestion with Structured Streaming
"""

__version__ = "0.1.0"
