"""A PySpark-native engine for board-game knowledge bases and training data."""
