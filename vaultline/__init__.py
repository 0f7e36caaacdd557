"""vaultline: a Spark-native Data Vault 2.0 build over operational and interval data."""

__version__ = "0.1.0"
