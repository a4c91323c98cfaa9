"""Publication of tables and the jobs composed from the operators."""
