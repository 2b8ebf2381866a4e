"""Training-data operators: token output, de-duplication, mixing, scans and classifiers over a documents table."""
