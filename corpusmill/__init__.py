"""A PySpark engine for building, cleaning and checking text corpora used to fine-tune language models."""
