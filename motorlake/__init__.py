"""motorlake: layered automotive business analytics on Spark DataFrames.

Raw CSV feeds are ingested incrementally, cleansed, historised (SCD2),
enriched with dimensions and aggregated into KPI, scorecard and anomaly
tables.  Every operator is a function from DataFrames to a DataFrame built
from Spark built-ins, so Catalyst plans the whole chain.
"""

DEFAULT_AS_OF = "1998-06-15"

__all__ = ["DEFAULT_AS_OF"]
