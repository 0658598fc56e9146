"""The cleaned tables, the feature tables and the reports built from the operators."""
