"""docgrain: document collections to keyed, evidence-carrying tables, as Spark DataFrame jobs."""
