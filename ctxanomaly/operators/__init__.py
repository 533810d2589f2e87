"""Table-to-table operators: records, hourly cells, context, z-score,
features, forest, exact ranks and reports."""
