"""Plans: the warehouse build over the test tables or over files, the query registry and the oracle SQL."""
