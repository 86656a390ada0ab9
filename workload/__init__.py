"""Driver workload: assay-shaped views over the given tables, the registered queries and their SQL counterparts."""
