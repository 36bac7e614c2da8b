"""Spark-native roster reconciliation and circulation reporting jobs."""
