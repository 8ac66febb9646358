"""lexweave: a Spark-native engine for curating lexical content and training corpora."""

__version__ = "0.1.0"
