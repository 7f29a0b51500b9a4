"""DataFrame operators: filters, ranking, pagination, merging, run history."""
