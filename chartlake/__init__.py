"""Chart analytics and retrieval jobs written as plain PySpark DataFrame functions."""
