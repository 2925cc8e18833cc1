"""Plans: staging, star-schema build, business questions, end-to-end pipelines."""
