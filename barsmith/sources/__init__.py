"""Sources and sinks: table fixtures, bar files, payloads, Kafka codec, store scans."""
