"""stratum: layered (bronze / silver / gold) analytics on Spark.

Every transform is a plain ``DataFrame -> DataFrame`` function with no I/O,
so the same code serves batch jobs, streaming micro-batches, tests and the
checked queries.  I/O lives in :mod:`stratum.sources`; whole runs in
:mod:`stratum.plans`.
"""

__version__ = "0.1.0"
