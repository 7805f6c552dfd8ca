"""A PySpark-native engine for curating chat, instruction and training text."""
