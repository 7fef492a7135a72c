"""functions of the document analytics engine."""
