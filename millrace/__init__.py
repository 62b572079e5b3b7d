"""millrace: data and language-model preparation work as Spark jobs."""
