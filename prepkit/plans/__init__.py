"""Model training, scoring and the end-to-end jobs built from the operators."""
