"""DataFrame operators: cleaning, outliers, documents, features, models, metrics and runs."""
