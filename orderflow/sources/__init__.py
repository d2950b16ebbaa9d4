"""What lies on shared storage: stage, job ledger, order table, source tables."""
