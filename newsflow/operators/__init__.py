"""DataFrame-in, DataFrame-out operators over article and tag tables."""
