"""DataFrame -> DataFrame operators, grouped by workload."""
