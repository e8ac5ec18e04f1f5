"""Reading and writing: files, JDBC tables, Kafka topics."""
