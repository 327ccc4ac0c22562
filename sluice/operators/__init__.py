"""DataFrame -> DataFrame operators of the sales lakehouse."""
