"""DataFrame-to-DataFrame operators: versions, series, statistics, dimensions."""
