"""Star schema, metric views and the reports built on them."""
