"""ledgerline: company-register analytics as Spark DataFrame jobs."""
