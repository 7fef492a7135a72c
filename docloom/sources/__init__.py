"""sources of the document analytics engine."""
