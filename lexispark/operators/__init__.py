"""Feature tables, classifiers, model selection, evaluation and corpus statistics."""
