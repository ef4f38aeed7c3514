"""A PySpark engine for business-registry analytics and training-data pipelines."""
