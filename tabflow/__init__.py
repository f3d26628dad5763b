"""tabflow: batch jobs over delimited tables, graphs and relational targets, on Spark."""
