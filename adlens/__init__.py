"""adlens: marketing-performance analytics as Spark DataFrame jobs.

Layers (each a function DataFrame in -> DataFrame out):

* ``sources``    file scans, staging, and the driver tables seen as ad/store exports
* ``functions``  column expressions: numeric cleaning, keys, dates, guarded ratios
* ``operators``  brand mapping, conversion fact, pivots, windows, marts, tabs,
                 report numbers, canned questions, quality and audit checks
* ``plans``      the named queries over the driver tables (and their SQL oracles)
* ``streaming``  incremental refresh of monthly partitions
"""

from adlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
