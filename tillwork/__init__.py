"""tillwork — point-of-sale ledger reconciliation as Spark DataFrame jobs.

Every public function takes and returns a ``DataFrame`` (or a ``Column``);
nothing is collected to the driver.  Sub-packages:

* ``functions``  – column expressions (scalars, predicates, nested parsing)
* ``operators``  – DataFrame operators (fills, keys, deduction, joins,
  links, split inventory, aggregates, explode/overlay)
* ``sources``    – landed JSON pages, invoices, store dimension, dated sinks
* ``plans``      – the composed daily reconciliation job and the
  driver-table query plans
* ``streaming``  – incremental landing of page files with Structured Streaming
"""

from tillwork.config import Semantics, ORD

__all__ = ["Semantics", "ORD"]
__version__ = "0.1.0"
