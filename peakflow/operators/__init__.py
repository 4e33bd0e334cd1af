"""DataFrame -> DataFrame operators: cleaning, time parts, labels, quality reports, traffic reports."""
