"""plumbline: table-quality, reconciliation and scoring operators for PySpark."""
