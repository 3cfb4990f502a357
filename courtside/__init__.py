"""courtside: head-to-head match analytics as composable Spark DataFrame functions."""
