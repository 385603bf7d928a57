"""DataFrame operators: relational helpers and the accounting operators (factors, models,
allocation, records, meters, inventory, report)."""
