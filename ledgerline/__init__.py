"""ledgerline: incremental sales-data ingestion and consolidation on Spark.

Everything here is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function; jobs are configuration over those functions.  See README.md.
"""

__version__ = "0.1.0"
