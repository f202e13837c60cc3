"""Tables and reports, put together from operators."""
