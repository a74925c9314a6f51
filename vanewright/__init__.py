"""Telemetry analytics and corpus preparation as composable Spark DataFrame functions."""
