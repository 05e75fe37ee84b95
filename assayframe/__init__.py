"""assayframe: data-quality rules, record validation, text gates, entities, payloads
and quality metrics as PySpark DataFrame operators."""

__version__ = "0.1.0"
