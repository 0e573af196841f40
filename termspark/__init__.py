"""Clinical-terminology ETL, cross-maps, text vectors and ontology as Spark jobs."""
