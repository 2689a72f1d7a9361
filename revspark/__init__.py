"""revspark: review-sentiment analytics as composable Spark DataFrame functions.

Every public function takes and returns DataFrames (or Columns); nothing
pulls a table through the driver.  Sub-packages:

* ``functions`` – column expressions: text cleaners, label mappers, tokens.
* ``operators`` – DataFrame -> DataFrame operators: filters, quality
  statistics, corpus statistics, column detection, splits, stage modes,
  evaluation, embeddings and model training.
* ``sources``   – readers (CSV with encoding / separator candidates, driver
  tables) and sinks (split and embedding tables, run metadata).
* ``plans``     – the registered queries and their DuckDB oracles, and the
  end-to-end job.
* ``streaming`` – the stateless cleaning steps applied to a stream.
"""

__version__ = "0.1.0"
