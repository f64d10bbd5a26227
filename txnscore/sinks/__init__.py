"""Writers of tables and topics that survive the replay of a micro-batch."""
