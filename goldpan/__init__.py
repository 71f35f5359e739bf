"""goldpan: e-commerce medallion tables and question-log analytics as Spark jobs."""
