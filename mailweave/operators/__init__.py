"""DataFrame operators: joins, rankings, keyword and vector scoring, metrics."""
