"""Reading and writing the raw, trusted and refined zones."""
