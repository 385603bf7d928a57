"""Sources and sinks: schemas, table readers, CSV with the NA token, writers, scratch folders."""
