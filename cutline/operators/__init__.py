"""DataFrame-to-DataFrame operators: parsing, cleaning, marts, lookup, reports, quality and privacy."""
