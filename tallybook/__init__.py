"""tallybook: a Spark-native double-entry ledger data platform.

Every public function takes and returns DataFrames. Nothing is collected to
the driver on a data path; all joins, groupings and windows are declared with
the DataFrame API so Catalyst/AQE choose the physical plan.
"""

__version__ = "0.1.0"
