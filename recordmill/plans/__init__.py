"""End-to-end batch jobs put together from the operators."""
