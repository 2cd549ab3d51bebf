"""DataFrame -> DataFrame operators (batch and streaming where stateless)."""
