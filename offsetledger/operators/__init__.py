"""DataFrame operators: records, commit-log selection, offset audit."""
