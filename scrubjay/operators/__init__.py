"""DataFrame -> DataFrame operators: cleaning, quality, outliers, features, analysis."""
