"""orrery: a PySpark-native engine for annotation tables and dataset preparation."""
