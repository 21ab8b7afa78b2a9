"""Multi-head aspect classifier on Spark ML (ML-1/2/4/7, UDF-1/3)."""
