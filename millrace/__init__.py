"""Composable Spark operators for log mining, recommendation and supervised learning."""
