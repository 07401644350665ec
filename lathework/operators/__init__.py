"""DataFrame-to-DataFrame operators and fit/transform stages."""
