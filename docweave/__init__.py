"""A PySpark-native analytics engine for disclosure documents and the facts drawn from them."""
