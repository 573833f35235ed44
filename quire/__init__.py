"""quire: Spark-native operators for document, catalogue and ledger pipelines."""

__version__ = "0.1.0"
