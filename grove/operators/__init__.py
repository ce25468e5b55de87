"""DataFrame operators: preparation, binning, histograms, splits, routing, correction, scoring, metrics."""
