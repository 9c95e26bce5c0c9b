"""Where trips come from: star tables, SQL text, JDBC, or generated rows."""
