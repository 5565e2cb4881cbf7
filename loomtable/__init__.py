"""Spark-native engine for curating structured listings and evaluating extraction models."""
