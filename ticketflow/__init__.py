"""ticketflow: service-request (ticket) analytics as Spark DataFrame plans.

Stages, each a function from DataFrames to DataFrames:

* ``sources``    – raw scans, schema contract, NA tokens, paged/landed inputs.
* ``operators``  – quality flags, duplicate detection, dimensions, cleaning,
                   enrichment, reconciliation.
* ``plans``      – the summary marts, ranked / top-k / dashboard queries and
                   the end-to-end stage composition.
* ``streaming``  – incremental (resume-from-cursor) ingestion.
* ``functions``  – column expressions shared by the above.

Nothing here collects data to the driver; every result is a lazy DataFrame.
"""

from ticketflow.settings import PipelineSettings, DEFAULT_SETTINGS  # noqa: F401

__all__ = ["PipelineSettings", "DEFAULT_SETTINGS"]
