"""revloom: revenue-operations data work as Spark DataFrame operators and jobs."""
