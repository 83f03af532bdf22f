"""DataFrame operators: tasks, lookup, columns, status, audit, landing."""
