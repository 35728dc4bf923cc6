"""keepwell: retention analytics expressed as Spark DataFrame jobs.

Transactions go in; point-in-time customer snapshots, eligibility audits,
evaluation metrics, budget-constrained contact decisions and drift reports
come out. Every operator is a DataFrame / Spark SQL / Spark ML plan; only
scalars (counts, fitted coefficients, bucket edges) ever reach the driver.
"""

__version__ = "0.1.0"
