"""Query plans: the registered report queries, their SQL oracle, pipelines."""
