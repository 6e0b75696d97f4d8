"""Case-review analytics on PySpark: DataFrame in, DataFrame out, many cases per job."""

__version__ = "0.1.0"
SCHEMA_VERSION = "1.0"
PRODUCER_VERSION = f"caseweave/{__version__}"
