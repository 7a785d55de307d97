"""Record-by-record processing of landed lines as a file stream."""
