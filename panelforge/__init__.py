"""Panel analytics on Spark: consolidation, screening and training-data preparation of country-by-year panels."""
