"""Silver views and gold marts, put together from the operators."""
