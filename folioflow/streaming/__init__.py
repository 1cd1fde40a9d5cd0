"""The library's transformations over streams (the batch operators are the reference point)."""
