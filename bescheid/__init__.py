"""bescheid: a PySpark-native engine for public planning and permit announcements."""
