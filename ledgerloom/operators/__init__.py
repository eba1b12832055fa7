"""DataFrame-to-DataFrame operators: cleaning, warehouse, reports, forecast."""
