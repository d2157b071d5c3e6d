"""quirelake: Spark-first operators for describing, cleaning and comparing large document collections."""

__version__ = "0.1.0"
