"""Writers and the table catalog."""
