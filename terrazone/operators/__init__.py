"""DataFrame operators. Every operator takes explicit key, value and weight columns."""
