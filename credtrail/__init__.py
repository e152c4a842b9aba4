"""credtrail: tax-credit reconciliation and leakage analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function that Catalyst plans and
the cluster executes. Sub-packages:

* ``sources``   -- declared schemas, readers/writers, data-quality rules, test-data adapter
* ``functions`` -- column expressions (normalisation, buckets, period parsing)
* ``operators`` -- reconciliation, leakage, risk, anomaly, forecast and the
                   generic join / id / quantile building blocks they use
* ``plans``     -- named analytic queries, dashboard queries, the pipeline runner
* ``streaming`` -- incremental (file-triggered) ingest of the input tables
"""

from credtrail.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]
