"""Tables are read and written in batches; there are no streaming operators."""
