"""Reading: files, delimited and JSON records, logs, binary events, Kafka, JDBC, tables."""
