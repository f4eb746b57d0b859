"""Document intelligence on Spark: text normalisation, components, chunks, enrichment, vectors and answers as lazy relations."""
