"""stratum: a layered (bronze / silver / gold) lakehouse expressed as Spark jobs."""

__version__ = "0.1.0"
