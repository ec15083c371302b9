"""Column expressions: cleaning, binning, ratios, comparisons."""
