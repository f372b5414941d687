"""replenix — retail replenishment analytics as Spark DataFrame / SQL jobs.

Daily point-of-sale orders and stock snapshots go in; demand per product,
preferred suppliers, net demand (MRP), purchase-order documents, a
data-quality report and dashboard reports come out.  Every operator is a
function ``DataFrame(s) -> DataFrame`` whose period column (``exec_date`` in
production) is a parameter, so the same code runs one day or a backfill.
"""

__version__ = "0.1.0"

DEFAULT_PERIOD = "exec_date"
