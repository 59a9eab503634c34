"""DataFrame operators: rules, profiles, histograms, bounds, joins and impact tables."""
