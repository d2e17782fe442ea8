"""tessera: establishment scoring and segmentation as Spark DataFrame jobs.

Sub-packages
------------
functions   native Column expressions (parsing, geography, ages, bands)
operators   DataFrame -> DataFrame building blocks (star join, rule cascades,
            skew-safe group statistics, analytics, data-quality checks)
sources     explicit schemas, readers, partitioned writers, extraction manifest
plans       composed pipelines: cleaning, enrichment, scored views, the model
            over the driver's star tables, and the query catalogue
streaming   incremental ingestion and scoring with Structured Streaming
rules       rule tables as data (scores, cascades, bands)
"""

__version__ = "0.1.0"
