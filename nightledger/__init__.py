"""nightledger: a Spark-first engine for dated rate offers, their snapshots and their texts."""

__version__ = "0.1.0"
